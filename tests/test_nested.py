import json
import random

from lamella.operators.nested import Index, Level, flatten_nested
from lamella.plans.nested_queries import LAYOUT


def readable(text):
    def no(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=no)
        return True
    except ValueError:
        return False


def test_grammar_agrees_with_a_parser():
    rnd = random.Random(11)
    seeds = ['{"a":[1,2,{"b":"x\\\\\\"y"}],"c":null}', '[[],{},"",-1.5e+3,true]', '"str\\u00e9"', ' {"k" : {"k":[{"z":[0]}]} } ', '""', "12", '{"a":1,"a":2}', ""]
    texts = list(seeds)
    for s in seeds:
        for _ in range(400):
            t = list(s)
            for _ in range(rnd.randrange(1, 4)):
                i = rnd.randrange(len(t) + 1)
                if rnd.random() < 0.4 and t:
                    del t[min(i, len(t) - 1)]
                elif rnd.random() < 0.8:
                    t.insert(i, rnd.choice('{}[],:"\\ 0123tfn.e-u\n\x01é'))
                else:
                    t = t[:i]
            texts.append("".join(t))
    bad = Index([t.encode() for t in texts]).bad
    assert [readable(t) for t in texts] == [not b for b in bad]


def rows(spark, *groups, layout=LAYOUT):
    df = spark.createDataFrame([("t", i, g, x, "extra") for i, (g, x) in enumerate(groups)], "source_table string, record_no long, group_name string, group_text string, entity string")
    return sorted((r.record_no, r.entity, r.parent_path, r.record_path) for r in flatten_nested(df, layout).collect())


def test_shapes(spark):
    D = "/endpoints/descriptors"
    got = rows(spark, ("endpoints", json.dumps({"descriptors": {"a/b~": {"signature": {"params": [None, 1, {"x": 2}]}, "errors": {"class": "E"}}, "n": None, "u": "__undefined", "s": 3}})))
    own = f"{D}/a~1b~0"
    assert got == sorted([(0, "endpoint", "", own), (0, "param", own, f"{own}/signature/params/1"), (0, "param", own, f"{own}/signature/params/2"), (0, "error", own, f"{own}/errors/0"), (0, "endpoint", "", f"{D}/s")])
    listed = json.dumps([{"descriptors": [{"name": "q", "errors": "__undefined"}, None, {"name": "é", "errors": []}]}])
    want = [(0, "endpoint", "", f"{D}/q"), (0, "endpoint", "", f"{D}/é")]
    assert rows(spark, ("endpoints", listed)) == want
    assert rows(spark, ("endpoints", json.dumps(json.dumps([json.dumps(listed)])))) == want


def test_channels_and_headers(spark):
    ws = {"subscribe": {"channels": {"w": ["a", None, "b"], "one": "c", "none": None}}, "dispatch": {"entries": {"channel": 1}}}
    p = "/websocket/subscribe/channels"
    assert rows(spark, ("websocket", json.dumps(ws))) == sorted([
        (0, "channel", f"{p}/w", f"{p}/w/0"), (0, "channel", f"{p}/w", f"{p}/w/2"), (0, "channel", f"{p}/one", f"{p}/one/0"), (0, "dispatch", "", "/websocket/dispatch/entries/0"),
    ])
    cases = {"cases": [None, {"output": {"headers": {"A/B": None, "C": "1"}}}, {"output": None}]}
    assert rows(spark, ("", json.dumps(cases))) == sorted([
        (0, "case", "", "/cases/1"), (0, "case", "", "/cases/2"), (0, "header", "/cases/1", "/cases/1/output/headers/A~1B"), (0, "header", "/cases/1", "/cases/1/output/headers/C"),
    ])


def test_unreadable_null_empty_and_repeated_keys(spark):
    assert rows(spark, ("auth", None), ("auth", ""), ("auth", "{"), ("auth", '"x"'), ("auth", "[]"), ("auth", "[1,2]"), ("auth", '{"sign_recipe":[1'), ("other", "{}"), (None, "{}")) == []
    twice = '{"sign_recipe":{"r":{"steps":[1,2]},"r":{"steps":[3]}}}'
    p = "/auth/sign_recipe/r"
    assert rows(spark, ("auth", twice), ("auth", twice)) == sorted((i, *x) for i in (0, 1) for x in (("recipe", "", p), ("step", p, f"{p}/steps/0")))
    assert rows(spark) == []


def test_deep_and_long(spark):
    deep = "[" * 3000 + '{"x":[1]}' + "]" * 3000
    layout = {"g": (Level("e", ("x",), "list"),)}
    assert rows(spark, ("g", deep), layout=layout) == [(0, "e", "", "/g/x/0")]
    long = json.dumps({"x": ["é" * 3_000_000, "\\\""]})
    assert len(rows(spark, ("g", long), ("g", long), layout=layout)) == 4
