import hashlib
import zlib

import pytest
from edge_rows import EDGE_TEXTS

from scoreloom.llm import merkle

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def path_of(levels, i):
    steps = []
    for level in levels[:-1]:
        start = i - i % 3
        steps.append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
        i //= 3
    return steps


def plain(rows):
    """The whole result, with every level held."""
    groups = {}
    for row in rows:
        doc_id, text, _, source, _ = row
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        altered = leaf_of(row, text.replace("\n", "") if even and text is not None else text)
        key = (doc_id is not None, doc_id or 0, leaf_of(row, text))
        groups.setdefault((source is not None, (source or "").encode()), []).append((key, altered))
    trees = [(tree_of([k[2] for k, _ in sorted(groups[g])]), sorted(groups[g])) for g in sorted(groups)]
    top = tree_of([levels[-1][0] for levels, _ in trees])
    found = []
    for g, (levels, leaves) in enumerate(trees):
        for i, ((known, doc_id, leaf), altered) in enumerate(leaves):
            path = path_of(levels, i) + path_of(top, g)
            node = altered
            for left, right in path:
                node = sha(left, node, right)
            root = top[-1][0]
            proof = sha(*[x for step in path for x in step])
            found.append((doc_id if known else None, leaf, levels[-1][0], root, proof, node, node == root))
    return sorted(found, key=repr)


def ours(spark, rows, every):
    frame = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 AS idx", "2 AS n", "'g' AS grp", "3 AS path", "'d' AS digest")
    return sorted(map(tuple, merkle.row_manifest(frame.repartition(3), every).collect()), key=repr)


def many(sizes):
    return [
        (10 * i + g, f"text {i}\nof {g}\n" * (i % 3), "en", source, i)
        for g, (source, size) in enumerate(sizes.items())
        for i in range(size)
    ]


@pytest.mark.parametrize("every", [1, 4])
def test_every_digest_equals_the_plain_tree(spark, every):
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "c": 82, "é": 250, "z": 9, "~": 27, "ab": 28}
    assert ours(spark, many(sizes), every) == plain(many(sizes))


def test_one_source_and_one_row(spark):
    for sizes in ({"s": 1}, {"s": 82}):
        assert ours(spark, many(sizes), 4) == plain(many(sizes))


def test_edges(spark):
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s", None if k % 5 else 7) for k, (i, t) in enumerate(EDGE_TEXTS)]
    rows += [(4, "Eins\nzwei", "en", "s", 7)] * 3 + [(None, None, None, None, None)] * 4
    assert ours(spark, rows, 1) == plain(rows)
    assert ours(spark, [], 4) == []


def test_only_removed_line_feeds_are_seen(spark):
    rows = many({"s": 60})
    found = {r[0]: r[6] for r in ours(spark, rows, 2)}
    for row in rows:
        even = zlib.crc32(str(row[0]).encode()) % 2 == 0
        assert found[row[0]] == (not even or "\n" not in row[1])
    assert {*found.values()} == {True, False}


def test_only_every_few_levels_are_stored(spark):
    leaves = spark.createDataFrame([(f"{i:05d}",) for i in range(1000)], "digest string").selectExpr("'g' AS grp", "digest")
    made = merkle.manifest(leaves, [], every=2)
    assert [level.count() for level in made.groups.stored] == [1000, 112, 13, 2, 1]
    assert made.root().first()[0] == tree_of([f"{i:05d}" for i in range(1000)])[-1][0]
    assert made.subroots().count() == 1
    paths = made.proofs([]).collect()
    assert {len(r["path"]) for r in paths} == {7} and len(paths) == 1000


def test_a_large_group_is_numbered_in_parts(spark):
    rows = spark.range(4000).selectExpr("if(id % 4 = 0, '-', '=hot') AS grp", "id", "'x' AS n0")
    placed = merkle.placed_in_groups(rows.repartition(5), "grp", ["id"]).collect()
    for grp, size in (("-", 1000), ("=hot", 3000)):
        mine = sorted((r["id"], r["idx"], r["n"]) for r in placed if r["grp"] == grp)
        assert [m[1] for m in mine] == list(range(size)) and {m[2] for m in mine} == {size}
