"""The strict rules, each payload with the rows that a row-wise reader gives."""

import pytest

from scoreloom.operators.games import player_games
from scoreloom.operators.strict import player_games_strict
from scoreloom.sources.landing import documents_from_strings
from scoreloom.workload import matches as m

G = '{"puuid":"a","championName":"X","kills":1,"deaths":2,"assists":3,"win":true}'
QUOTED_A, QUOTED_7 = '"a"', '"7"'
B = '{"puuid":"b","championName":"Z","kills":9,"deaths":9,"assists":9,"win":false}'
X = ("M1", "X", 1, 2, 3, True)


def doc(participants, metadata='"metadata":{"matchId":"M1"},'):
    return f'{{{metadata}"info":{{"participants":{participants}}}}}'


RULES = [
    ("plain", doc(f"[{B},{G}]"), [X]),
    ("no object before", doc(f"[5,{G}]"), []),
    ("no object after", doc(f"[{G},5]"), [X]),
    ("no object after, text", doc(f'[{B},{G},"x",null]'), [X]),
    ("null before", doc(f"[null,{G}]"), []),
    ("null after", doc(f"[{G},null]"), [X]),
    ("array before", doc(f"[[],{G}]"), []),
    ("trailing text", doc(f"[{G}]") + " x", []),
    ("trailing document", doc(f"[{G}]") + doc(f"[{G}]"), []),
    ("trailing document after a comma", doc(f"[{G}]") + "," + doc(f"[{G}]"), []),
    ("trailing brace", doc(f"[{G}]") + "}", []),
    ("trailing bracket", doc(f"[{G}]") + "]", []),
    ("trailing blanks", " " + doc(f"[{G}]") + " \n", [X]),
    ("metadata text", doc(f"[{G}]", '"metadata":"s",'), []),
    ("metadata null", doc(f"[{G}]", '"metadata":null,'), []),
    ("metadata array", doc(f"[{G}]", '"metadata":[],'), []),
    ("metadata absent", doc(f"[{G}]", ""), [("", *X[1:])]),
    ("match id absent", doc(f"[{G}]", '"metadata":{},'), [("", *X[1:])]),
    ("match id null", doc(f"[{G}]", '"metadata":{"matchId":null},'), []),
    ("match id number", doc(f"[{G}]", '"metadata":{"matchId":7},'), [("7", *X[1:])]),
    ("match id object", doc(f"[{G}]", '"metadata":{"matchId":{"q":1}},'), [("{q=1}", *X[1:])]),
    ("match id array", doc(f"[{G}]", '"metadata":{"matchId":[1,"b",{"c":null}]},'), [("[1, b, {c=null}]", *X[1:])]),
    ("match id looks nested", doc(f"[{G}]", '"metadata":{"matchId":"{q"},'), [("{q", *X[1:])]),
    ("champion object", doc(f'[{G.replace(chr(34) + "X" + chr(34), "{\"q\":\"r\"}")}]'), [("M1", "{q=r}", 1, 2, 3, True)]),
    ("participants object", doc(G), []),
    ("participants text", doc('"a"'), []),
    ("participants null", doc("null"), []),
    ("participants absent", '{"metadata":{"matchId":"a"},"info":{}}', []),
    ("info absent", '{"metadata":{"matchId":"a"}}', []),
    ("entry without id first", doc(f'[{{"championName":"a"}},{G}]'), [X]),
    ("first of two", doc(f'[{G},{{"puuid":"a","championName":"Y"}}]'), [X]),
    ("other types after an odd entry", doc(f'[{G.replace("1,", "1.5,").replace("true", "1")},5]'), [("M1", "X", None, 2, 3, None)]),
    ("key twice", doc(f"[{G}]", '"metadata":{"matchId":"M0","matchId":"M1"},'), [X]),
    ("not a number", doc(f'[{G.replace("1,", "NaN,")}]'), [("M1", "X", None, 2, 3, True)]),
    ("broken", doc(f"[{G}]")[:-3], []),
    ("empty", "", []),
    ("null", None, []),
    ("single quotes", doc(f"[{G}]").replace('"', "'"), []),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(str(i), payload) for i, (_, payload, _) in enumerate(RULES)]
    frame = spark.createDataFrame(rows, "i string, json_payload string")
    return {i: [tuple(r) for r in player_games_strict(frame.where(f"i = '{i}'"), "a").collect()] for i, _ in rows}


@pytest.mark.parametrize("i", range(len(RULES)), ids=[name for name, _, _ in RULES])
def test_rules(found, i):
    assert found[str(i)] == RULES[i][2]


def test_an_id_that_is_no_text_is_nobodys(spark):
    number = G.replace('"a"', "7")
    payloads = [doc(f"[{number}]"), doc(f"[{number},{G.replace(QUOTED_A, QUOTED_7)}]")]
    landed = documents_from_strings(spark, payloads)
    assert [tuple(r) for r in player_games_strict(landed, "7").collect()] == [X]
    assert player_games(landed, "7").count() == 2


def test_sure_documents_need_no_second_form(spark, sf_dir):
    whole = m.documents(spark, sf_dir)
    strict, plain = player_games_strict(whole, "P7"), player_games(whole, "P7")
    assert strict.exceptAll(plain).isEmpty() and plain.exceptAll(strict).isEmpty()
    marked = whole.limit(20).selectExpr("replace(json_payload, 'kills', 'k\\\\u0069lls') AS json_payload")
    assert player_games_strict(marked, "P7").count() == player_games(marked, "P7").count()
