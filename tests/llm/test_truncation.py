import random

import lamella.llm.truncation as U

WORDS = "market header sandbox currency payload ticker account listing snapshot cursor".split()


def sentence(rnd):
    return f"The {rnd.choice(WORDS)} returns a {rnd.choice(WORDS)} before the {rnd.choice(WORDS)} expires."


def corpus(seed=0, n=150):
    rnd = random.Random(seed)
    return [(i, " ".join(sentence(rnd) for _ in range(rnd.randrange(2, 9))), "notes") for i in range(n)]


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "kind") for r in rows], "doc_id long, text string, source string, h1 int, kind string")
    return sorted(r.doc_id for r in U.truncated(df).collect())


def test_last_words(spark):
    rows = corpus() + [
        (1000, "The market returns a header before the cursor expires. The sand", "notes"),
        (1001, "The market returns a header before the cursor expires. The market returns a", "other"),
        (1002, "The market returns a header before the cursor expires. The market returns a", None),
        (1003, "The market returns a header before the cursor expires...", "notes"),
        (1004, "The market returns a header bef…", "notes"),
        (1005, "The market returns a header before the cursor exp�", "notes"),
        (1006, "```\n{\"a\": 1}", "notes"), (1007, "/** The market", "notes"), (1008, "| a | b |\n| c | d |", "notes"), (1009, "| a | b |\n| c", "notes"),
        (1010, None, "notes"), (1011, "", "notes"), (1012, " \n\t", "notes"), (1013, "The market returns a header before the cursor expires", "notes"),
    ]
    assert found(spark, rows) == [1000, 1001, 1002, 1004, 1005, 1006, 1007, 1009]


def test_limit_of_a_source(spark):
    rnd = random.Random(1)
    rows = corpus()
    for i in range(40):
        rows.append((2000 + i, " ".join(sentence(rnd) for _ in range(12))[:300], "short"))
    rows += [(2100, " ".join(sentence(rnd) for _ in range(12)), "free")]
    got = found(spark, rows)
    assert [i for i in got if 2000 <= i < 2040] == list(range(2000, 2040)) and 2100 not in got and not [i for i in got if i < 1000]


def test_longer_copies(spark):
    df = spark.createDataFrame([(1, 1, "abc"), (2, 2, "abcd"), (3, 3, "abd"), (4, 4, "abd"), (5, 5, "z"), (6, 6, "abce")], "h1 long, h2 long, value string")
    assert sorted(r.h1 for r in U.strict_prefixes(df).collect()) == [1]
    rnd = random.Random(2)
    values = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 9))) for _ in range(400)]
    many = spark.createDataFrame([(i, i, v) for i, v in enumerate(values)], "h1 long, h2 long, value string")
    want = [i for i, v in enumerate(values) if any(w != v and w.startswith(v) for w in values)]
    assert sorted(r.h1 for r in U.strict_prefixes(many).collect()) == want
    assert U.strict_prefixes(many.limit(0)).collect() == []


def test_empty_table_and_report(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame([(1, "a b", "s"), (2, " ", "s"), (3, "c", None)], "doc_id long, text string, source string")
    got = {(r.source, r.texts, r.cut) for r in U.truncation_report(docs, docs.select("doc_id").where("doc_id = 3")).collect()}
    assert got == {("s", 1, 0), (None, 1, 1)}


def test_sign_offs_whose_word_goes_on_inside_sentences(spark):
    rnd = random.Random(3)
    rows = [(i, f"{sentence(rnd)} The Ops desk of the {rnd.choice(WORDS)} waits. {sentence(rnd)}\n\nBest,\nOps", "mail") for i in range(60)]
    rows += [(100 + i, f"{sentence(rnd)} {sentence(rnd)}\nThanks", "mail") for i in range(20)]
    rows += [(200, f"{sentence(rnd)} The Ops", "mail"), (201, f"{sentence(rnd)} The Ops de", "mail")]
    assert found(spark, corpus() + [(5000 + i, t, s) for i, t, s in rows]) == [5200, 5201]


def test_lines_that_are_never_last(spark):
    rnd = random.Random(4)
    rows = [(i, "\n".join([" * @param " + sentence(rnd).rstrip(".") for _ in range(3)] + [" */"]), "doc") for i in range(40)]
    rows += [(100, "\n".join(" * @param " + sentence(rnd).rstrip(".") for _ in range(3)), "doc")]
    assert found(spark, rows) == [100]


def test_followers_against_brute_force(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 6))) for _ in range(300)]
    passages = {f"1{w}{rnd.choice([U.GOES_ON, U.ENDS, U.OPEN])}": rnd.randrange(1, 4) for w in words}
    asked = sorted({"1" + w for w in words[:80]} | {"1abab", "1b", "2", "1", "zz"})
    want = {}
    for t in asked:
        counts = [0, 0, 0, 0]
        for v, n in passages.items():
            if v.startswith(t):
                counts[U._kind(v[len(t)])] += n
        want[t] = tuple(counts)
    for width in ("1", "5", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            got = U.followers(spark.createDataFrame(sorted(passages.items()), "value string, n long"), spark.createDataFrame([(t,) for t in asked], "value string"))
            assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_copies_of_a_text_count_once(spark):
    rows = corpus() + [(1000 + i, "The market returns a header before the cursor expires. The market ret", "notes") for i in range(300)]
    assert found(spark, rows) == list(range(1000, 1300))


def test_a_longer_text_where_the_trail_tells_nothing(spark):
    rows = corpus() + [(1000, "Zyx qwv unheard", "notes"), (1001, "Zyx qwv unheard-of things happen.", "notes"), (1002, "q", "notes"), (1003, "Zz", "notes")]
    assert 1000 in found(spark, rows) and 1003 not in found(spark, rows)
    df = spark.createDataFrame([(1, 1, "abcde"), (2, 2, "abcdefg"), (3, 3, "x"), (4, 4, "abcdf"), (5, 5, "xylophone")], "h1 long, h2 long, text string")
    ends = spark.createDataFrame([(1, 1, 5), (3, 3, 1), (4, 4, 5)], "h1 long, h2 long, n_bare long")
    assert sorted(r.h1 for r in U.longer_copies(df, ends).collect()) == [1, 3]
    assert U.longer_copies(df, ends.limit(0)).collect() == []
