"""Texts that lost their end: prefix joins of last words, sentences, lines and whole texts; field limits.

A cut value is a strict prefix of what it was. Few cut texts have a longer copy, so the
join is put to what every text has: its *trail*, the words after which it stops. Trails
and passages of all texts are sorted together, and what begins with a trail follows it
at once. Passages say what came next: the rest of the word, another word, or an end. A
trail is unfinished where the corpus only ever goes on, and a usual end where it also
ends. Trails are compared from the start of their sentence, then with the two words
before the last one, one, and none, until some passage begins with them. Lines that
start like lines that are never last are found by their first two words, and texts whose
trail tells nothing are joined with all texts by prefix. Length limits of the
sources confirm.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.plans.runtime import broadcast_if_small, durable

#: Characters of text that are taken apart at once.
CHUNK_CHARS = 4_000_000
#: Distinct words whose forms a worker keeps; the store is emptied beyond that.
FORMS_KEPT = 500_000
#: A word, sentence or opening is a usual end if it ends at least this share of what it occurs in.
USUAL = 0.05
#: Lines that start alike are never last if this share of at least so many is.
NEVER_LAST, LINES_SEEN = 0.02, 20
#: Chance below which it is no accident that a sentence never ended where its words usually may.
CHANCE = 0.01

# Letters of scripts that are written without spaces, ends of sentences, characters that may follow an end, marks put at a cut.
_UNSPACED = "぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ"
_ENDS = ".!?。！？…"
_CLOSERS = "\"'”’»)]}*_`"
_MARKS = ("[truncated]", "[cut]", "[more]", "[...]", "[…]", "(truncated)", "(continued)", "(more)")
_PUNCTUATION = "、。，！？…」』）：；"
_LETTER = re.compile(f"[{_UNSPACED}]")
_TOKEN = re.compile(f"[{_UNSPACED}][{_PUNCTUATION}]*|[^\\s{_UNSPACED}]+")
#: Words with a capital after their first character are names of a kind.
NAME = "[A-Za-z0-9]+[A-Z][A-Za-z0-9]*"
_NAME, _DIGITS = re.compile(NAME), re.compile(r"\d+")
START = "^"
#: What follows a passage: a further word, an end, the open end of its own text.
GOES_ON, ENDS, OPEN = " ", "\x01", "\x02"


class _Forms(dict):
    """(form as context, form with what follows it) of a word; digits are one, a word that ends a sentence is a start as context."""

    def __missing__(self, w: str) -> tuple[str, str]:
        if len(self) > FORMS_KEPT:
            self.clear()
        core = w.rstrip(_CLOSERS)
        ends = bool(core) and core[-1] in _ENDS
        plain = _DIGITS.sub("0", (core.rstrip(_ENDS) or w) if ends else w).replace(ENDS, "").replace(OPEN, "")
        form = (START, plain + ENDS) if ends else (_NAME.sub("X", plain) if plain != START else "^^", plain + GOES_ON)
        self[w] = form
        return form


def cut_mark(text: str) -> int | None:
    """Where the mark begins that a text ends with, spaces before it included; null without one.

    Three or more dots, an ellipsis, a word in brackets in any case, or characters that broke.
    """
    bare = text.rstrip()
    if bare.endswith("�"):
        return len(bare.rstrip("�"))
    if bare.endswith("…"):
        return len(bare[:-1].rstrip())
    if bare.endswith("..."):
        return len(bare.rstrip(".").rstrip())
    tail = bare[-max(map(len, _MARKS)) :].lower()
    return next((len(bare[: -len(m)].rstrip()) for m in _MARKS if tail.endswith(m)), None)


def _terminated(text: str) -> bool:
    bare = text.rstrip().rstrip(_CLOSERS)
    return bool(bare) and bare[-1] in _ENDS


def open_structure(text: str) -> bool:
    """Whether a code fence, a block comment, a table row or a brace stays open at the end."""
    last = text.rstrip().rsplit("\n", 1)[-1]
    return (
        text.count("```") % 2 == 1
        or text.count("/**") > text.count("*/")
        or (last.startswith("|") and not last.endswith("|"))
        or text.count("{") > text.count("}")
    )


def _words(line: str) -> list[str]:
    return _TOKEN.findall(line) if not line.isascii() and _LETTER.search(line) else line.split()


_PARTS = pa.schema(
    [(c, pa.string()) for c in ("kind", "a", "b", "c", "sentence", "first", "second")]
    + [(c, pa.int64()) for c in ("n", "h1", "h2", "n_bare")]
    + [(c, pa.bool_()) for c in ("marked", "broken", "structure")]
)
PARTS = "kind string, a string, b string, c string, sentence string, first string, second string, n long, h1 long, h2 long, n_bare long, marked boolean, broken boolean, structure boolean"


def _take_apart(rows: list[tuple[int, int, str]], forms: _Forms) -> pa.RecordBatch:
    out: list[tuple] = []
    context: list[str] = []
    follows: list[str] = []
    sentences: list[str] = []
    openers: list[tuple] = []
    for h1, h2, text in rows:
        mark = cut_mark(text)
        bare = text if mark is None else text[:mark]
        lines = [line for line in bare.split("\n") if line and not line.isspace()]
        open_ = bool(lines) and not _terminated(bare)
        trail = (None,) * 6
        words = str.split if bare.isascii() else _words
        for nr, line in enumerate(lines, 1):
            ctx, nxt = map(list, zip(*[forms[w] for w in words(line)]))
            last = nr == len(lines)
            nxt[-1] = nxt[-1][:-1] + (OPEN if last and open_ else ENDS)
            first = line[: len(line) - len(line.lstrip())] + (ctx[0] if ctx[0] != START else nxt[0])
            second = (ctx[1] if ctx[1] != START else nxt[1]) if len(ctx) > 1 else ""
            openers.append((first, second, last))
            begin, end = 0, len(ctx) - 1
            for _ in range(ctx.count(START) - (ctx[end] == START)):
                i = ctx.index(START, begin)
                sentences.append(" ".join([*ctx[begin:i], nxt[i]]))
                begin = i + 1
            sentences.append(" ".join([*ctx[begin:end], nxt[end]]))
            context += (START, START)
            context += ctx
            follows += ("", "")
            follows += nxt
            if last and open_:
                trail = (context[-3], context[-2], nxt[-1][:-1], sentences[-1][:-1], first, second)
        out.append(("text", *trail, None, h1, h2, len(bare), mark is not None, text.rstrip().endswith("�"), open_ and open_structure(bare)))
    blank = (None,) * 6
    windows = Counter(zip(context, context[1:], follows[2:]))
    out += [("words", a, b, c, None, None, None, n, *blank) for (a, b, c), n in windows.items() if c]
    out += [("sentence", None, None, None, s, None, None, n, *blank) for s, n in Counter(sentences).items()]
    out += [("line", None, None, "last" if last else "mid", None, f, s, n, *blank) for (f, s, last), n in Counter(openers).items()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)


def take_texts_apart(texts: DataFrame) -> DataFrame:
    """Of (h1, h2, text) rows: a row per text with its trail (null where it ends a sentence), and counts per chunk.

    Counts are of three words and what follows them, of sentences, and of the first
    two words of lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = _Forms()
        held, size = [], 0
        for b in batches:
            for row in zip(b["h1"].to_pylist(), b["h2"].to_pylist(), b["text"].to_pylist()):
                held.append(row)
                size += len(row[2])
                if size > CHUNK_CHARS:
                    yield _take_apart(held, forms)
                    held, size = [], 0
        if held:
            yield _take_apart(held, forms)

    return texts.select("h1", "h2", "text").mapInArrow(run, PARTS)


_FOLLOWED = pa.schema([("kind", pa.string()), ("part", pa.int64()), ("level", pa.int64()), ("value", pa.string())] + [(c, pa.int64()) for c in ("inside", "on", "ends", "open")])
FOLLOWED = "kind string, part long, level long, value string, inside long, on long, ends long, open long"


def _kind(following: str) -> int:
    return 1 if following == GOES_ON else 2 if following == ENDS else 3 if following == OPEN else 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOLLOWED)], schema=_FOLLOWED)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of sorted values: questions open while values begin with them; each value counts for all that are open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    open_: list[list] = []
    head: str | None = None
    shared, prefix = 0, ""
    levels: dict[int, list[int]] = {}
    for b in batches:
        out: list[tuple] = []
        for v, n in zip(b["value"].to_pylist(), b["n"].to_pylist()):
            if head is None:
                head = prefix = v
                shared = len(v)
            while open_ and not v.startswith(open_[-1][0]):
                t, counts = open_.pop()
                out.append(("done", part, None, t, *counts))
            if n is None:
                open_.append([v, [0, 0, 0, 0]])
                continue
            for t, counts in open_:
                counts[_kind(v[len(t)])] += n
            if shared:
                # What is shared with the first value of the range only ever gets shorter.
                while not v.startswith(prefix):
                    shared = next((i for i, (x, y) in enumerate(zip(prefix, v)) if x != y), min(len(prefix), len(v)))
                    prefix = prefix[:shared]
                levels.setdefault(shared, [0, 0, 0, 0])[_kind(v[shared]) if len(v) > shared else 0] += n
        if out:
            yield _batch(out)
    if head is not None:
        rows = [("head", part, None, head, 0, 0, 0, 0)] + [("level", part, level, None, *c) for level, c in levels.items()]
        yield _batch(rows + [("edge", part, None, t, *c) for t, c in open_])


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Questions that were open at the end of their range, with what the ranges after it begin with."""
    parts: dict[int, dict] = {}
    for b in batches:
        for r in b.to_pylist():
            p = parts.setdefault(r["part"], {"levels": {}, "edges": []})
            counts = [r[c] for c in ("inside", "on", "ends", "open")]
            if r["kind"] == "head":
                p["head"] = r["value"]
            elif r["kind"] == "level":
                p["levels"][r["level"]] = counts
            else:
                p["edges"].append((r["value"], counts))
    open_: list[tuple[str, list[int]]] = []
    done: list[tuple] = []
    for nr in sorted(parts):
        p = parts[nr]
        still = []
        for t, counts in open_:
            if not p["head"].startswith(t):
                done.append(("done", nr, None, t, *counts))
                continue
            for level, c in p["levels"].items():
                if level == len(t):
                    counts = [x + y for x, y in zip(counts, c)]
                elif level > len(t):
                    counts[_kind(p["head"][len(t)])] += sum(c)
            still.append((t, counts))
        open_ = still + p["edges"]
    done += [("done", None, None, t, *counts) for t, counts in open_]
    if done:
        yield _batch(done)


def followers(passages: DataFrame, asked: DataFrame) -> DataFrame:
    """What follows each asked value in the passages that it is a strict prefix of: (value, inside, on, ends, open).

    ``passages`` are (value, n), each value once; ``asked`` are distinct (value). The join is one
    sort of both, in ranges; a value's continuations come right after it, so a
    stack of the values that are open is all that a task holds. What reaches over the
    bounds of ranges is made up from the beginnings of the ranges that follow, a
    few rows for each range. Null values are left out.
    """
    width = int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = passages.select("value", "n").unionByName(asked.select("value", F.lit(None).cast("long").alias("n"))).where("value is not null")
    found = durable(both.repartitionByRange(width, "value").sortWithinPartitions("value").mapInArrow(_sweep, FOLLOWED))
    over = found.where("kind <> 'done'").repartition(1).mapInArrow(_over_edges, FOLLOWED)
    return found.where("kind = 'done'").unionByName(over).select("value", "inside", "on", "ends", "open")


FAMILIES = ("S", "3", "2", "1", "5", "4")


def _with_names(c: str) -> Column:
    return F.regexp_replace(c, NAME, "X")


def _family_values(sentence: bool) -> Column:
    """A trail or passage (a, b, c) in its families: with two words before the last, one, none; names also as names."""
    named = F.when(_with_names("c") != F.col("c"), _with_names("c"))
    values = [
        F.concat(F.lit("3"), "a", F.lit(" "), "b", F.lit(" "), "c"), F.concat(F.lit("2"), "b", F.lit(" "), "c"), F.concat(F.lit("1"), "c"),
        F.concat(F.lit("5"), "a", F.lit(" "), "b", F.lit(" "), named), F.concat(F.lit("4"), "b", F.lit(" "), named),
    ]
    if sentence:
        values.append(F.concat(F.lit("S"), "sentence"))
    return F.array_compact(F.array(*values))


def judged_trails(parts: DataFrame) -> DataFrame:
    """(h1, h2, cut, closing) of the texts that stop at a trail; ``parts`` is written.

    ``cut`` is true where the corpus goes on after the trail, false where it is a usual
    end, null where no passage begins with it. ``closing`` tells that it is an end that
    other texts share and hardly anything follows. Trails are judged once each,
    however many texts share one.
    """
    texts = parts.where("kind = 'text' and c is not null").withColumns({"t1": F.xxhash64("sentence", "a", "b", "c", "first", "second"), "t2": F.xxhash64(F.lit(2), "second", "first", "c", "b", "a", "sentence")})
    trails = texts.select("t1", "t2", "a", "b", "c", "sentence", "first", "second").dropDuplicates(["t1", "t2"])
    ask = durable(trails.select("t1", "t2", F.explode(_family_values(True)).alias("value")))
    windows = parts.where("kind = 'words'").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))
    passages = windows.select(F.explode(_family_values(False)).alias("value"), "n").unionByName(
        parts.where("kind = 'sentence'").select(F.concat(F.lit("S"), "sentence").alias("value"), "n")
    ).groupBy("value").agg(F.sum("n").alias("n"))
    counts = durable(followers(passages, ask.select("value").distinct()))
    seen = ask.join(broadcast_if_small(counts), "value").withColumn("family", F.substring("value", 1, 1))
    columns = {f"{c}{f}": F.sum(F.when(F.col("family") == f, F.col(c))) for f in FAMILIES for c in ("inside", "on", "ends", "open")}
    wide = seen.groupBy("t1", "t2").agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in columns.items()])

    openers = lambda first, second: F.explode(F.array(F.concat(F.lit("1"), first), F.concat(F.lit("2"), first, F.lit("\x01"), second)))
    lines = parts.where("kind = 'line'").select(openers("first", "second").alias("opener"), "c", "n").groupBy("opener").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("c") == "last", F.col("n")).otherwise(0)).alias("last")
    )
    never = durable(lines.where((F.col("all") - F.col("last") >= LINES_SEEN) & (F.col("last") < NEVER_LAST * (F.col("all") - F.col("last")))).select("opener"))
    opened = trails.select("t1", "t2", openers("first", "second").alias("opener")).join(broadcast_if_small(never), "opener", "left_semi").select("t1", "t2").distinct()

    cut, closing = _judgement()
    never_last = F.col("opened").isNotNull()
    told = wide.join(opened.withColumn("opened", F.lit(True)), ["t1", "t2"], "left").select(
        "t1", "t2", F.when(never_last, True).otherwise(cut).alias("cut"), (closing & ~never_last).alias("closing")
    )
    return texts.select("h1", "h2", "t1", "t2").join(told, ["t1", "t2"]).select("h1", "h2", "cut", "closing")


def _judgement() -> tuple[Column, Column]:
    """Whether a trail is unfinished, by the first of its families that tells, and whether it is a closing."""
    inside, on, ends = ({f: F.col(f"{c}{f}") for f in FAMILIES} for c in ("inside", "on", "ends"))
    others = {f: F.col(f"open{f}") - 1 for f in FAMILIES}
    full = {f: on[f] + ends[f] for f in FAMILIES}
    usual = {f: (ends[f] > 0) & (ends[f] >= USUAL * full[f]) for f in FAMILIES}
    # An end that other texts share and that hardly anything follows.
    closing = {f: (others[f] >= 3) & (2 * others[f] >= on[f] + inside[f]) for f in ("S", "3")}
    rate = F.coalesce(*[F.when(full[f] >= 5, ends[f] / full[f]) for f in ("3", "5", "2", "4", "1")], F.lit(0.5))
    rarely = {f: others[f] <= 0.2 * inside[f] for f in FAMILIES}

    def part(f: str, least: int, word: int) -> Column:
        return (inside[f] > 0) & (full[f] == 0) & rarely[f] & (((inside[f] >= least) & (full["1"] < word)) | (inside[f] >= LINES_SEEN))

    yes, no = F.lit(True), F.lit(False)
    j = F.when(usual["S"], no).when(closing["S"] & closing["3"], no)
    j = j.when((on["S"] > 0) & (ends["S"] == 0) & (F.pow(1 - rate, on["S"]) < CHANCE), yes).when(part("S", 1, 1), yes)
    j = j.when(usual["3"], no).when(closing["3"], no).when(part("3", 1, 3), yes).when((on["3"] >= 2) & (on["3"] > others["3"]), yes)
    j = j.when(usual["2"], no).when(part("2", 1, 3), yes).when((on["2"] >= 2) & (on["2"] > others["2"]), yes)
    for f in ("5", "4"):
        j = j.when(usual[f], no).when(on[f] >= 3, yes)
    j = j.when(usual["1"], no).when(part("1", 3, 3), yes).when((on["1"] >= 2) & (on["1"] > others["1"]), yes)
    return j, closing["S"] & closing["3"]


_HITS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("edge", pa.string()), ("part", pa.int64()), ("value", pa.string())])


def strict_prefixes(values: DataFrame) -> DataFrame:
    """(h1, h2) of the (h1, h2, value) rows whose value is a strict prefix of another row's value.

    The values are sorted in ranges. What a value is a prefix of follows it at once,
    so each needs its next different value only, across the bounds of ranges too. A
    common beginning of any length, whatever part of the rows shares it, spreads over
    as many ranges as its rows need; repeated rows spread by their hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        here: str | None = None
        same: list[tuple[int, int]] = []
        for b in batches:
            hits: list[tuple] = []
            for h1, h2, value in zip(b["h1"].to_pylist(), b["h2"].to_pylist(), b["value"].to_pylist()):
                if value != here:
                    if here is None:
                        hits.append((None, None, "first", part, value))
                    elif value.startswith(here):
                        hits += [(*s, None, part, None) for s in same]
                    here, same = value, []
                same.append((h1, h2))
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*hits), _HITS)], schema=_HITS)
        if same:
            hits = [(*s, "last", part, here) for s in same]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*hits), _HITS)], schema=_HITS)

    width = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = values.select("h1", "h2", "value").repartitionByRange(width, "value").sortWithinPartitions("value")
    found = durable(laid.mapInArrow(run, "h1 long, h2 long, edge string, part long, value string"))
    first = found.where("edge = 'first'").select("part", "value")
    # One row per range: its first value, and that of the next range that has any.
    following = first.select("part", F.lead("value").over(Window.orderBy("part")).alias("next"))
    edge = found.where("edge = 'last'").join(broadcast_if_small(following), "part").where(F.col("next").startswith(F.col("value")) & (F.col("next") != F.col("value")))
    return found.where("edge is null").select("h1", "h2").unionByName(edge.select("h1", "h2"))


def longer_copies(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """(h1, h2) of the (h1, h2, n_bare) texts in ``ends`` that are strict prefixes of other texts of ``rows`` (h1, h2, text).

    Texts meet by the hash of as many of their first characters as the greatest power of
    two that the shorter one has; only those that meet are moved and sorted in full.
    """
    power = F.floor(F.log2("n_bare")).cast("int")
    asked = durable(ends.withColumn("k", power))
    powers = sorted(r[0] for r in asked.select("k").distinct().collect())  # one number for each power of two
    if not powers:
        return ends.select("h1", "h2")
    start = lambda k: F.xxhash64(F.lit(k), F.substring("text", 1, 2**k))
    own = F.when(F.lit(False), F.lit(None).cast("long"))
    for k in powers:
        own = own.when(F.col("k") == k, start(k))
    keys = durable(rows.join(broadcast_if_small(asked.select("h1", "h2", "k")), ["h1", "h2"]).select("k", own.alias("start"), start(powers[0]).alias("least")).distinct())
    # What shares more shares the shortest beginning too, so most texts go after one look.
    near = rows.withColumn("least", start(powers[0])).join(broadcast_if_small(keys.select("least").distinct()), "least", "left_semi")
    by_power = [F.when(F.length("text") >= 2**k, F.struct(F.lit(k).alias("k"), start(k).alias("start"))) for k in powers]
    met = near.select("h1", "h2", "text", F.explode(F.array_compact(F.array(*by_power))).alias("s")).select("h1", "h2", "text", "s.*")
    met = met.join(broadcast_if_small(keys.select("k", "start").distinct()), ["k", "start"], "left_semi")
    texts = met.groupBy("h1", "h2").agg(F.any_value("text").alias("text"))
    bare = texts.join(broadcast_if_small(asked.select("h1", "h2", "n_bare")), ["h1", "h2"], "left")
    values = bare.select("h1", "h2", F.expr("substring(text, 1, coalesce(n_bare, length(text)))").cast("string").alias("value"))
    return strict_prefixes(values).join(asked.select("h1", "h2"), ["h1", "h2"], "left_semi")


def field_limits(lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Limits that the sources' lengths show, from distinct (source, h1, h2, chars, bytes) rows.

    First (source, unit, length, longer): lengths that at least 5 texts have and 10
    times as many as lengths within 40 of it, with whether longer texts exist.
    Second (source, block, low, high): the greatest power of two from 64 to 1024
    that divides 6 times as many lengths as chance would (null if none), and the
    band of the 16 greatest lengths if texts pile up all over it. Groups are lengths, not
    texts, so a source with a third of all rows is no larger than another.
    """
    pairs = F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("b").alias("unit"), F.col("bytes").alias("n"))))
    per = durable(lengths.select("source", pairs.alias("p")).groupBy("source", "p.unit", "p.n").agg(F.count("*").alias("k")))
    near = Window.partitionBy("source", "unit").orderBy("n").rangeBetween(-40, 40)
    whole = Window.partitionBy("source", "unit")
    seen = per.withColumns({"near": (F.sum("k").over(near) - F.col("k")) / 80, "most": F.max("n").over(whole)})
    spikes = seen.where((F.col("n") >= 100) & (F.col("k") >= 5) & (F.col("k") >= 10 * F.greatest("near", F.lit(0.1))))
    spikes = spikes.select("source", "unit", "n", (F.col("most") > F.col("n")).alias("longer"))
    chars = seen.where("unit = 'c'")
    block = F.greatest(*[
        F.when((F.col(f"b{b}") >= 5) & (F.col(f"b{b}") >= 6 * F.col("all") / b), F.lit(b)) for b in (64, 128, 256, 512, 1024)
    ])
    in_band = F.col("n") > F.col("most") - 16
    before = (F.col("n") <= F.col("most") - 16) & (F.col("n") > F.col("most") - 176)
    total = lambda on: F.coalesce(F.sum(F.when(on, F.col("k"))), F.lit(0))
    rules = chars.groupBy("source").agg(
        F.sum("k").alias("all"), F.max("most").alias("high"), total(in_band).alias("band"), total(before).alias("before"),
        F.max(F.when(in_band, F.col("k"))).alias("top"),
        *[total(F.col("n") % b == 0).alias(f"b{b}") for b in (64, 128, 256, 512, 1024)],
    )
    # A pile at one length is a spike; here the texts end at words, a little before the limit.
    spread = F.col("band") - F.col("top")
    piled = (spread >= 10) & (spread >= F.col("before")) & (F.col("high") >= 100)
    return spikes, rules.select("source", block.alias("block"), F.when(piled, F.col("high") - 16).alias("low"), "high")


def _hashed(text: Column) -> dict[str, Column]:
    return {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("second"), text)}


def truncated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Ids of the documents whose text lost its end: (doc_id).

    A mark that a source puts at the cut (dots, an ellipsis, a word in brackets, a
    broken character) belongs to the cut and is left aside. The rest is cut if its
    trail is unfinished; if it is as long as a limit of its source and no closing; or, where the
    trail tells nothing, if a longer text begins with it or a structure stays open. A broken
    last character is proof by itself. At a limit, texts that end a sentence count
    only if the source has no longer ones. Null, empty and blank texts are none. A
    copy of a cut text is a case whatever its source; a null source is a source of
    its own. Repeated rows are repeated.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("\u0000")).alias("source"), F.col(text).cast("string").alias("text")
    ).where(F.col("text").rlike(r"(?U)\S"))
    hashed = rows.withColumns(_hashed(F.col("text")))
    parts = durable(take_texts_apart(hashed.groupBy("h1", "h2").agg(F.any_value("text").alias("text"))))
    ends = parts.where("kind = 'text'")
    small = durable(hashed.select("doc_id", "source", "h1", "h2", F.length("text").alias("chars"), F.octet_length("text").alias("bytes")))
    certain = ends.where("broken").select("h1", "h2")
    judged = durable(judged_trails(parts))
    unfinished = judged.where("cut").select("h1", "h2")

    untold = ends.join(judged.where("cut is null"), ["h1", "h2"], "left_semi").select("h1", "h2", "n_bare", "structure")
    untold = durable(untold)
    copies = longer_copies(hashed.select("h1", "h2", "text"), untold.where("n_bare > 0 and not structure").select("h1", "h2", "n_bare"))
    left_open = untold.where("structure").select("h1", "h2")

    # Limits of the sources.
    keyed = small.groupBy("source", "h1", "h2").agg(F.any_value("chars").alias("chars"), F.any_value("bytes").alias("bytes"))
    keyed = durable(keyed)
    spikes, rules = field_limits(keyed)
    spikes, rules = broadcast_if_small(durable(spikes)), broadcast_if_small(durable(rules))
    units = keyed.select("source", "h1", "h2", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("b").alias("unit"), F.col("bytes").alias("n")))).alias("p"))
    full = units.select("source", "h1", "h2", "p.*").join(spikes, ["source", "unit", "n"]).select("h1", "h2", F.lit("full").alias("why"), "longer")
    high = F.coalesce(F.col("chars") > F.col("low"), F.lit(False))
    block = keyed.join(rules, "source").where((F.col("chars") % F.col("block") == 0) | high).select("h1", "h2", F.lit("block").alias("why"), (F.coalesce(F.col("chars") % F.col("block"), F.lit(1)) > 0).alias("longer"))
    # A closing is no cut, even where it sits at a limit by chance.
    at = full.unionByName(block).join(ends.select("h1", "h2", "marked", F.col("c").isNotNull().alias("open")), ["h1", "h2"]).join(judged.where("closing").select("h1", "h2"), ["h1", "h2"], "left_anti")
    limits = at.where("(why = 'full' and (not longer or marked or open)) or (why = 'block' and open and not (longer and marked))").select("h1", "h2")

    cut = certain.unionByName(unfinished).unionByName(copies).unionByName(left_open).unionByName(limits)
    return small.select("doc_id", "h1", "h2").join(broadcast_if_small(durable(cut.distinct())), ["h1", "h2"], "left_semi").select("doc_id")


def truncation_report(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Per source: texts that are not blank, cut ones, and their share."""
    flagged = docs.where(F.col("text").rlike(r"(?U)\S")).select("source", "doc_id").join(found.distinct().withColumn("cut", F.lit(1)), "doc_id", "left")
    return flagged.groupBy("source").agg(F.count("*").alias("texts"), F.count("cut").alias("cut"), F.round(F.count("cut") / F.count("*"), 4).alias("share"))
