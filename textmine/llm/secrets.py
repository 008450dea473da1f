"""Secrets: known forms by pattern, and strings that look random by a battery of tests.

All of it is built-in functions. Offsets of matches come from the lengths of the pieces between them.
Long tokens are tested per inferred encoding for a uniform alphabet (chi-squared over all characters and
over two classes of them), for runs and for serial correlation, and the tests are joined by Fisher's method.
Tokens for which randomness is rejected are set aside, with the false discovery rate controlled separately
per range of lengths, as longer tokens are easier to judge; the others are flagged. Among letters alone the
tests look where words differ from chance: at the most frequent letters and at vowels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmine.sources.scratch import written

# The base forms.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_SIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ASSIGN_CHARS = 8
KINDS = ["assign", "access", "hex"]
# A maximal run of token characters.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
RATE = 0.05
# Lower ends of the ranges of lengths, and the resolution of -ln p in the table of counts.
LENGTHS = [20, 32, 48, 64]
STEPS, MOST_BINS = 20, 400
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# The first encoding that fits. Letters or digits alone are no hexadecimal numbers.
ENCODINGS = [
    ("base10", "^[0-9]+$", DIGITS),
    ("base26", "^[a-z]+$", LOWER),
    ("base26", "^[A-Z]+$", UPPER),
    ("base52", "^[A-Za-z]+$", UPPER + LOWER),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("base36", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64url", "^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("base64", "^", UPPER + LOWER + DIGITS + "+/-_="),
]
# The vowels, and the ten letters that European languages use most.
VOWELS, FREQUENT = "aeiouAEIOU", "etaoinsrhlETAOINSRHL"
# Matches of a text that are placed one after the other; a text with more is placed chunk by chunk.
CHUNK = 256


def _found(kind: str, text: Column, sign: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of ``(kind, start, end, value)`` of all matches, empty unless ``sign`` holds."""
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )
    kind_of = "struct<at: int, spans: array<struct<kind: string, start: int, end: int, value: string>>>"

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["g"])
        end = start + F.length(m["w"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), m["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def spans(p: Column) -> Column:
        zipped = F.arrays_zip(
            F.slice(p["gaps"], F.lit(1), F.size(p["whole"])).alias("g"), p["whole"].alias("w"), p["value"].alias("v")
        )
        zero = F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(kind_of)
        # Offsets within a chunk, and then where each chunk begins, so that the work stays linear.
        last = F.floor((F.size(p["whole"]) - 1) / CHUNK).cast("int")
        chunks = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda c: F.aggregate(F.slice(zipped, c * CHUNK + 1, F.lit(CHUNK)), zero, step),
        )
        begins = F.aggregate(
            chunks,
            F.array(F.lit(0)),
            lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])),
        )
        return F.flatten(
            F.zip_with(
                chunks,
                F.slice(begins, F.lit(1), F.size(chunks)),
                lambda c, at: F.transform(
                    c["spans"],
                    lambda x: F.struct(
                        x["kind"].alias("kind"), (x["start"] + at).alias("start"), (x["end"] + at).alias("end"),
                        x["value"].alias("value"),
                    ),
                ),
            )
        )

    # The transform binds the three regular expressions to one evaluation each.
    made = F.flatten(F.transform(F.array(parts), spans))
    return F.when(sign, made).otherwise(F.array().cast("array<struct<kind: string, start: int, end: int, value: string>>"))


def _normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal, by a logistic curve (absolute error below 2e-4)."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def _tests(token: Column) -> Column:
    """``(encoding, length, p)`` of a token: four tests joined by Fisher's method.

    Trailing ``=`` is padding. p is small when the token does not look like random characters.
    """
    body = F.regexp_replace(token, "=+$", "")
    name, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for encoding, pattern, letters in reversed(ENCODINGS[:-1]):
        name = F.when(body.rlike(pattern), encoding).otherwise(name)
        alphabet = F.when(body.rlike(pattern), letters).otherwise(alphabet)
    first = F.struct(body.alias("body"), name.alias("encoding"), alphabet.alias("alphabet"))

    def chars(s: Column) -> Column:
        marks = F.filter(F.split(s["body"], ""), lambda c: c != "")
        words = s["encoding"].isin("base26", "base52")
        half = F.length(s["alphabet"]) / 2

        def of(listed: str) -> Column:
            """Whether each character is in one class: that of the list for words, else the upper half."""
            return F.transform(
                marks,
                lambda c: F.when(words, F.instr(F.lit(listed), c) > 0)
                .otherwise(F.instr(s["alphabet"], c) > half)
                .cast("int"),
            )

        upper = F.floor(F.length(s["alphabet"]) - half) / F.length(s["alphabet"])
        return F.struct(
            s["encoding"].alias("encoding"),
            words.alias("words"),
            F.length(s["alphabet"]).cast("double").alias("k"),
            F.transform(marks, lambda c: F.instr(s["alphabet"], c)).alias("x"),
            of(VOWELS).alias("high"),
            of(FREQUENT).alias("frequent"),
            F.when(words, F.lit(len(FREQUENT) / 52)).otherwise(upper).alias("share"),
        )

    def judged(s: Column) -> Column:
        x, k, n = s["x"], s["k"], F.size(s["x"]).cast("double")
        zero = F.lit(0.0)
        squares = F.aggregate(
            F.array_distinct(x),
            zero,
            lambda acc, v: acc + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)),
        )
        chi, df = squares * k / n - n, k - 1
        # Wilson and Hilferty: the cube root of chi-squared is close to normal.
        uniform = (F.pow(F.greatest(chi, zero) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        high = s["high"]
        n1 = F.aggregate(high, zero, lambda acc, v: acc + v)
        n2 = n - n1
        pairs = F.sequence(F.lit(1), F.size(x) - 1)
        runs = 1 + F.aggregate(
            pairs, zero, lambda acc, i: acc + F.abs(F.get(high, i) - F.get(high, i - 1))
        )
        mean = 2 * n1 * n2 / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9)))
        # One class alone cannot alternate; it is the extreme of the runs test.
        along = F.when((n1 == 0) | (n2 == 0), F.lit(8.0)).otherwise(F.abs(runs - mean) / spread)
        # Chi-squared over two classes, as its signed root: words have too many frequent letters, never too few.
        expected = n * s["share"]
        root = (F.aggregate(s["frequent"], zero, lambda acc, v: acc + v) - expected) / F.sqrt(expected * (1 - s["share"]))
        classes = F.when(s["words"], _normal_tail(root)).otherwise(2 * _normal_tail(F.abs(root)))
        centre = F.aggregate(x, zero, lambda acc, v: acc + v) / n
        var = F.aggregate(x, zero, lambda acc, v: acc + (v - centre) * (v - centre))
        lagged = F.aggregate(
            pairs, zero, lambda acc, i: acc + (F.get(x, i) - centre) * (F.get(x, i - 1) - centre)
        )
        serial = F.when(var > 0, F.abs(F.try_divide(lagged, var) + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0))
        tests = F.array(_normal_tail(uniform), 2 * _normal_tail(along), classes, 2 * _normal_tail(serial))
        half = F.aggregate(tests, zero, lambda acc, p: acc - F.log(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1.0))))
        return F.struct(s["encoding"].alias("encoding"), n.cast("int").alias("length"), half.alias("half"))

    def joined(s: Column) -> Column:
        """The upper tail of chi-squared with two degrees of freedom a test, at twice ``half``."""
        h = s["half"]
        tail = F.exp(-h) * (1 + h + h * h / 2 + h * h * h / 6)
        return F.struct(s["encoding"], s["length"], F.least(tail, F.lit(1.0)).alias("p"))

    steps = F.transform(F.transform(F.transform(F.array(first), chars), judged), joined)
    return steps[0].cast("struct<encoding: string, length: int, p: double>")


def _stratum(length: Column) -> Column:
    value = F.lit(0)
    for i, low in enumerate(LENGTHS[1:], 1):
        value = F.when(length >= low, i).otherwise(value)
    return value


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-12))) * STEPS), F.lit(MOST_BINS)).cast("int")


def rejection_bins(tested: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per range of lengths the bin of p from which on randomness is rejected.

    Benjamini and Hochberg on counts per bin: the largest p with p <= rate * rank / number. The table
    has a bounded number of rows, whatever the number of tokens; every token is counted.
    """
    counts = tested.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    falling = Window.partitionBy("stratum").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy("stratum"))
    ranked = counts.withColumns({"rank": F.sum("n").over(falling), "total": total})
    passing = ranked.where(F.exp(-F.col("bin") / STEPS) <= rate * F.col("rank") / F.col("total"))
    return {r["stratum"]: r["bin"] for r in passing.groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """``(doc_id, base, added)``: spans ``(kind, start, end)`` of every row of ``docs``.

    ``base`` has the known forms, by start, then kind as listed; ``added`` the tokens of 20 and more
    characters for which randomness is not rejected and which overlap no base span, of kind ``random``.
    Every such token is tested and counted, whatever its characters. The text is read once; candidates go through a written table, and only
    counts are shuffled. Null and empty texts have no spans, null ids and repeated rows keep a row
    each, an empty table gives an empty result, other columns are ignored.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text"))
    t = F.col("text")
    assign = _found("assign", t, t.rlike(ASSIGN_SIGN), ASSIGN, 2)
    assign = F.filter(assign, lambda s: F.length(s["value"]) >= ASSIGN_CHARS)
    access = _found("access", t, t.contains("AKIA"), ACCESS)
    hexes = _found("hex", t, t.rlike("[0-9a-f]{32}"), HEX)
    tokens = _found("random", t, t.rlike(TOKEN), TOKEN)
    found = rows.select(
        "doc_id",
        assign.alias("assign"),
        access.alias("access"),
        hexes.alias("hex"),
        F.transform(
            tokens, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _tests(s["value"]).alias("t"))
        ).alias("tokens"),
    )
    stored = written(found, "secret-candidates")
    tested = stored.select(F.explode("tokens.t").alias("t")).select(
        _stratum(F.col("t.length")).alias("stratum"), _bin(F.col("t.p")).alias("bin")
    )
    bins = rejection_bins(tested, rate)
    limit = F.lit(MOST_BINS + 1)
    ranked = F.concat(
        *[
            F.transform(kind, lambda s, i=i: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
            for i, kind in enumerate(KINDS)
        ]
    )
    base = F.transform(
        F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    with_base = stored.select("doc_id", base.alias("base"), "tokens")

    def random(s: Column) -> Column:
        threshold = limit
        for stratum, low in bins.items():
            threshold = F.when(_stratum(s["t"]["length"]) == stratum, low).otherwise(threshold)
        apart = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return (_bin(s["t"]["p"]) < threshold) & apart

    added = F.transform(
        F.filter("tokens", random),
        lambda s: F.struct(F.lit("random").alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return with_base.select("doc_id", "base", added.alias("added"))
