"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests finds.

Patterns (kinds assign, access and hex) are leftmost non-overlapping matches of each kind.

The battery (kind random) looks at every run of at least ``TOKEN`` characters of the base64
alphabets. An encoding is inferred from the characters of the run (hex, base32, base36, letters
only, base64), which gives each character a value. A token is a candidate if three tests do not
tell it from random values: chi-squared against a uniform alphabet, the number of runs above and
below the middle value, and the correlation of neighbouring values (each at level ``LEVEL``).
Its p-value is the probability of so small a chi-squared statistic if the token were ordinary
text, whose letters are unevenly frequent: then the statistic has a mean of k-1+n*u and a
variance of 2(k-1)+4n*u, n being the length, k the alphabet's size and u the unevenness of text in
this encoding (``ENCODINGS``). Short tokens tell little, so candidates are tested in classes of
encoding and length, in each of which the procedure of Benjamini and Hochberg holds the share
of false discoveries at ``RATE``; its thresholds come from the counts over all texts, on a grid of
p-values that is rounded up. Normal probabilities are a logistic approximation. Tokens that
overlap a pattern's match are not reported again.

Everything is DataFrame functions, without a shuffle but that of the counts. Time is linear in a text's length, and
all but linear in its matches: places are running sums, overlaps a binary search among spans in order, and
spans are cut out of blocks of the text. Null texts count
as empty. Offsets are code points, ends are exclusive. Repeated rows are each scanned; an empty table
has no spans; one text is scanned in one task, whatever its length. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN = 20
LEVEL = 0.001
RATE = 0.01
KINDS = ("assign", "access", "hex", "random")

# Fixed values of the contract: what the patterns match.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{14,}"
_HEX = r"[0-9a-f]{16,}+"
# Words of which one must be in the lower-case text for an assignment to be there.
_ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
_TOKENS = r"(?<![\w+/-])[\w+/-]{%d,}+" % TOKEN

#: name, pattern, alphabet, unevenness of text (k * sum of squared frequencies - 1)
ENCODINGS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 3.0),
    ("letters", "^[A-Za-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.7),
    ("base32", "^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567", 1.0),
    ("base36", "^(?:[0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 1.3),
    ("base64", ".", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2.8),
)
_GRID = 200  # steps of a tenth of a power of ten
_CHUNK = 256
#: Code points of text that are taken apart at a time where spans are cut out.
_BLOCK = 4096


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used: a name for it inside a one-element array.

    What a lambda takes from a column instead may be put in its place by the optimizer, and then be computed for
    each element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column, start: int, merge) -> Column:
    """What ``merge`` makes of all entries before each, from ``start`` on, in time that stays small for very long
    arrays."""
    total = lambda xs: F.aggregate(xs, F.lit(start).cast("long"), merge)
    chunk = lambda i: F.floor(i / _CHUNK).cast("int")
    index = lambda xs: F.sequence(F.lit(0), F.size(xs) - 1)

    def of(xs: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), chunk(F.size(xs) - 1)),
            lambda c: total(F.slice(xs, c * _CHUNK + 1, F.lit(_CHUNK))),
        )
        whole = _let(chunks, lambda cs: F.transform(index(cs), lambda c: total(F.slice(cs, F.lit(1), c))))
        own = lambda i: total(F.slice(xs, chunk(i) * _CHUNK + 1, i - chunk(i) * _CHUNK))
        return _let(whole, lambda ws: F.transform(index(xs), lambda i: merge(F.get(ws, chunk(i)), own(i))))

    return F.when(F.size(values) > 0, _let(values, of)).otherwise(F.array().cast("array<bigint>"))


def _before(lengths: Column) -> Column:
    """Sums of what stands before each entry."""
    return _running(lengths, 0, lambda a, x: a + x)


def _ends_before(spans: Column) -> Column:
    """The furthest end of the spans before each; spans are in the order of their starts."""
    return _running(F.transform(spans, lambda s: s["end"]), 0, lambda a, x: F.greatest(a, x))


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that overlap none of the base spans, both in the order of their starts.

    A binary search finds how many spans start before a token's end; the furthest end of those tells.
    """
    closed = F.concat(base, F.array(F.struct(F.lit(2**62).alias("start"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("end"))))
    known = F.struct(F.transform(closed, lambda s: s["start"]).alias("starts"), _ends_before(closed).alias("ends"))
    halves = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])

    def free(spans: Column, steps: Column, t: Column) -> Column:
        count = F.aggregate(
            steps,
            F.lit(0),
            lambda n, step: n
            + F.when(
                (n + step <= F.size(spans["starts"])) & (F.get(spans["starts"], n + step - 1) < t["end"]), step
            ).otherwise(0),
        )
        return F.get(spans["ends"], count) <= t["start"]

    bound = F.struct(known.alias("spans"), halves.alias("steps"))
    return _let(bound, lambda b: F.filter(tokens, lambda t: free(b["spans"], b["steps"], t)))


def _matches(frame: DataFrame, name: str, pattern: str, if_any: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``name``: array of (start, end, text) of all matches of the pattern.

    The pattern is tried only where the lower-case text has one of the words, if any are given.
    """
    found, between, sizes, starts = (f"{name}_{x}" for x in ("found", "between", "sizes", "starts"))
    some = F.size(found) > 0
    size = lambda x: F.char_length(x).cast("long")
    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    all_found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if if_any:
        lower = f"{name}_lower"
        frame = frame.withColumn(lower, F.lower("text"))
        there = reduce(or_, [F.contains(lower, F.lit(w)) for w in if_any])
        all_found = F.when(there, all_found).otherwise(F.array().cast("array<string>"))
    return (
        frame.withColumn(found, all_found)
        .withColumn(between, F.when(some, F.split("text", pattern, -1)))
        .withColumn(sizes, F.when(some, F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: size(b) + size(m))))
        .withColumn(starts, F.when(some, _before(F.col(sizes))))
        .withColumn(
            name,
            F.when(
                some,
                F.transform(
                    found,
                    lambda m, i: F.struct(
                        (F.get(starts, i) + size(F.get(between, i))).alias("start"),
                        (F.get(starts, i) + F.get(sizes, i)).alias("end"),
                        m.alias("text"),
                    ),
                ),
            ).otherwise(none),
        )
        .drop(found, between, sizes, starts, f"{name}_lower")
    )


def _normal(z: Column) -> Column:
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _tested(token: Column) -> Column:
    """Of one token: class of encoding and length, step of its p-value, whether it may be random."""
    number = F.coalesce(*[F.when(token.rlike(e[1]), F.lit(i + 1)) for i, e in enumerate(ENCODINGS)])
    choose = lambda i, k: F.element_at(F.array(*[F.lit(e[k]) for e in ENCODINGS]), i)
    named = _let(number, lambda i: F.struct(choose(i, 0).alias("name"), choose(i, 2).alias("alphabet"), choose(i, 3).alias("u")))

    def valued(e: Column) -> Column:
        plain = F.when(e["name"] == "base64", F.translate(token, "-_", "+/")).otherwise(F.lower(token))
        return F.struct(
            e["name"].alias("name"),
            e["u"].alias("u"),
            F.char_length(token).cast("double").alias("n"),
            F.char_length(e["alphabet"]).cast("double").alias("k"),
            F.transform(F.split(plain, ""), lambda c: (F.instr(e["alphabet"], c) - 1).cast("double")).alias("x"),
        )

    return _let(_let(named, valued), _battery)


def _battery(b: Column) -> Column:
    n, k, x = b["n"], b["k"], b["x"]
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, v: a + v)
    # sum of squared counts = sum over distinct values of count squared
    squares = add(
        F.transform(
            F.array_distinct(x),
            lambda v: F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)),
        )
    )
    chi = squares * k / n - n
    upper = F.size(F.filter(x, lambda v: v >= k / 2)).cast("double")
    sides = F.zip_with(x, F.slice(x, F.lit(2), F.size(x) - 1), lambda v, w: F.when((v >= k / 2) != (w >= k / 2), 1.0).otherwise(0.0))
    # the last value has no neighbour: its comparison is with null and counts as no change
    runs = 1 + add(sides)
    mean = (k - 1) / 2
    variance = add(F.transform(x, lambda v: (v - mean) * (v - mean)))
    lagged = add(F.zip_with(x, F.slice(x, F.lit(2), F.size(x) - 1), lambda v, w: F.coalesce((v - mean) * (w - mean), F.lit(0.0))))
    sums = F.struct(chi.alias("chi"), upper.alias("up"), runs.alias("runs"), variance.alias("var"), lagged.alias("lag"))
    def judged(s: Column) -> Column:
        # Wilson and Hilferty's cube root for the upper tail of chi-squared
        df = k - 1
        cube = (F.pow(s["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        p_chi = 1 - _normal(cube)
        low = n - s["up"]
        expected = 1 + 2 * s["up"] * low / n
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9)))
        p_runs = 2 * _normal(-F.abs((s["runs"] - expected) / spread))
        z_lag = F.when(s["var"] > 0, s["lag"] / s["var"]).otherwise(1.0) * F.sqrt(n)
        p_lag = 2 * _normal(-F.abs(z_lag))
        p_text = _normal((s["chi"] - df - n * b["u"]) / F.sqrt(2 * df + 4 * n * b["u"]))
        step = F.floor(-10 * F.log10(F.greatest(p_text, F.lit(1e-30)))).cast("int")
        return F.struct(
            F.concat(b["name"], F.lit(":"), F.floor(2 * F.log2(n)).cast("string")).alias("class"),
            F.least(F.greatest(step, F.lit(0)), F.lit(_GRID)).alias("step"),
            ((p_chi > LEVEL) & (p_runs > LEVEL) & (p_lag > LEVEL)).alias("random"),
        )
    return _let(sums, judged)


def _tokens(frame: DataFrame) -> DataFrame:
    """Adds ``tokens``: array of (start, end, class, step, random)."""
    return _matches(frame, "raw", _TOKENS).withColumn(
        "tokens",
        F.transform(
            "raw",
            lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), _tested(t["text"]).alias("test")),
        ),
    ).drop("raw")


def thresholds(docs: DataFrame) -> dict[str, int]:
    """Of each class, the step from which on tokens are discoveries; classes without any are absent.

    All tokens of the class are tested, those that the battery rejects have p = 1. The counts are
    at most one row for each of some hundred classes and ``_GRID`` steps.
    """
    # no places are needed here, so the matches become rows before anything is tested
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_TOKENS), F.lit(0))
    tokens = docs.select(F.explode(found).alias("token")).select(_tested(F.col("token")).alias("t"))
    counts = tokens.groupBy(
        F.col("t.class").alias("class"), F.when(F.col("t.random"), F.col("t.step")).otherwise(0).alias("step")
    ).count()
    whole = Window.partitionBy("class")
    above = whole.orderBy(F.desc("step"))
    passed = (
        counts.withColumn("found", F.sum("count").over(above))
        .withColumn("tested", F.sum("count").over(whole))
        .filter(F.pow(F.lit(10.0), -F.col("step") / 10) * F.col("tested") <= RATE * F.col("found"))
        .groupBy("class")
        .agg(F.min("step").alias("step"))
    )
    return {r["class"]: r["step"] for r in passed.collect()}


def _with_spans(docs: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Adds ``base`` and ``all_spans``: sorted arrays of (start, kind's place in KINDS, end)."""
    frame = docs
    frame = _matches(frame, "assign", _ASSIGN, _ASSIGNED)
    frame = _matches(_matches(frame, "access", _ACCESS), "hex", _HEX)
    # group 2 is what follows the sign in the match; a value of 12 characters at least
    value = lambda m: F.regexp_extract(m["text"], f"^{_ASSIGN}$", 1)
    frame = frame.withColumn("assign", F.filter("assign", lambda m: F.char_length(value(m)) >= 12))
    span = lambda kind: lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")
    )
    frame = _tokens(frame).withColumn(
        "base", F.array_sort(F.concat(*[F.transform(k, span(k)) for k in ("assign", "access", "hex")]))
    )
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        found = F.filter("tokens", lambda t: t["test"]["random"] & (t["test"]["step"] >= F.element_at(limit, t["test"]["class"])))
        found = F.transform(_apart(found, F.col("base")), span("random"))
        frame = frame.withColumn("all_spans", F.array_sort(F.concat("base", found)))
    else:
        frame = frame.withColumn("all_spans", F.col("base"))
    return frame


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per kind and spans of every row (``base`` without the battery's)."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = lambda k: F.size(F.filter("all_spans", lambda s: s["kind"] == k)).cast("long")
    return _with_spans(own, thresholds(docs)).select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        _joined("base").alias("base"),
        _joined("all_spans").alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, each text's secrets (overlapping ones together) replaced by the mark.

    ``n_chars``, if there, is counted anew where the text changes. Null texts stay null.
    """
    own = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    frame = _with_spans(own, thresholds(docs)).select("row", "text", "all_spans")
    bound = F.struct(
        F.col("all_spans").alias("spans"),
        _ends_before(F.col("all_spans")).alias("before"),
        F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % _BLOCK), F.lit(0)).alias("blocks"),
    )

    def cut_out(b: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            """The text from start to end, of the blocks that it touches."""
            first = F.floor(start / _BLOCK).cast("int")
            n = F.floor(end / _BLOCK).cast("int") - first + 1
            near = F.array_join(F.slice(b["blocks"], first + 1, n), "")
            return F.substring(near, (start - first * _BLOCK + 1).cast("int"), (end - start).cast("int"))

        def piece(s: Column, i: Column) -> Column:
            done = F.get(b["before"], i)
            return F.when(s["start"] >= done, F.concat(part(done, s["start"]), F.lit(mark))).otherwise("")

        end = F.aggregate(b["spans"], F.lit(0).cast("long"), lambda a, s: F.greatest(a, s["end"]))
        pieces = F.array_join(F.transform(b["spans"], piece), "")
        return F.concat(pieces, part(end, F.char_length("text").cast("long")))

    cut = _let(bound, cut_out)
    frame = frame.withColumn("clean", F.when(F.size("all_spans") > 0, cut))
    columns = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        if name == "text":
            old = F.coalesce("clean", old)
        elif name == "n_chars":
            old = F.coalesce(F.char_length("clean").cast(docs.schema[name].dataType), old)
        columns.append(old.alias(name))
    return frame.select(*columns)


