"""Landed files: compressed, of bounded size, and read back as they were."""

from pathlib import Path

from scoreloom.sources import landing
from scoreloom.sources.landing import documents_from_strings, land_documents, read_documents
from scoreloom.sources.shared import publish


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "DOCUMENTS_PER_FILE", 400, raising=False)
    payloads = [f'{{"metadata":{{"matchId":"M{n}"}},"info":{{"participants":[]}},"note":"é"}}' for n in range(1000)]
    payloads += ["", "not json", payloads[0]]
    path = str(tmp_path / "landing")
    for mode in ("errorifexists", "append"):
        land_documents(documents_from_strings(spark, payloads).coalesce(1), path, mode)
    files = sorted(Path(path).glob("part-*"))
    assert len(files) == 6  # a compressed file is read by one task
    assert sum(f.stat().st_size for f in files) * 4 < 2 * sum(len(p.encode()) + 1 for p in payloads)
    assert sorted(r[0] for r in read_documents(spark, path).collect()) == sorted(payloads * 2)


def test_published_documents_are_stored_in_a_denser_form(spark):
    payloads = [f'{{"metadata":{{"matchId":"M{n}-{n * 7919 % 1000}"}}}}' for n in range(2000)]
    documents = documents_from_strings(spark, payloads)
    stored = publish(documents, "documents")
    assert stored.schema == documents.schema and sorted(r[0] for r in stored.collect()) == sorted(payloads)
    assert all(name.endswith(".zstd.parquet") for name in stored.inputFiles())
