"""Secrets in texts, with DataFrame functions only.

Three kinds follow from patterns (assignments, access keys, long hex runs). The fourth comes
from entropy: candidate strings are read through a sliding window whose Shannon entropy is
kept up to date by the counts of the one character that enters and the one that leaves, and
the largest value is held against the threshold of the string's character class. An allow
list suppresses candidates such as identifiers in UUID form or placeholders.

Positions come from the texts between the matches: a match starts where the gaps and matches
before it end.

Cases: a null or empty text has no spans. The time a text takes grows with its length and its hits, not with
their square. Spans with the same start are listed by kind. Null ids and repeated rows stay, one result per
input row; an empty table gives an empty result; other columns of the input are ignored.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Runs of 20 or more characters.
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
#: Hits whose places are worked out in one go.
STRETCH = 256

#: Character classes in the order in which they are tried, with the bits a window must reach.
CLASSES = (
    ("^[0-9_=+/-]+$", None),
    ("^[A-Za-z+/_=-]+$", 3.6),
    ("^[0-9a-fA-F-]+$", 3.0),
    ("^([a-z0-9_-]+|[A-Z0-9_-]+)$", 3.4),
    ("^[A-Za-z0-9+/_=-]+$", 3.6),
)

#: Letters of one case, or words in camel case: after capitals come two small letters or more.
_NAME = "(?:[a-z]++|[a-z]?(?:[A-Z]*+[a-z]{2,}+)*+[A-Z]*+)"

ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|placeholder|changeme|dummy|xxxx",
    "(?i)0123456789|abcdefgh",
    f"^{_NAME}(?:[+/_=-]++{_NAME})*+[0-9]*$",
)

_SPAN = "array<struct<s: bigint, e: bigint, kind: int>>"


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once, as the entry of an array, wherever it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(text: Column, pattern: str, hits: Column, sizes: Column, least: int, kind: int) -> Column:
    """Spans of the hits whose entry in ``sizes`` is at least ``least``.

    Hits are taken in stretches, whose starts come first: a list is copied once per stretch that grows it, not once per hit of the text.
    """
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), sizes.alias("size"))
    zero = F.lit(0).cast("bigint")

    def step(state, x):
        begin = state["at"] + F.char_length(x["gap"])
        end = begin + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        span = F.struct(begin.alias("s"), end.alias("e"), F.lit(kind).alias("kind"))
        added = F.concat(state["spans"], F.array(span))
        return F.struct(end.alias("at"), F.when(x["size"] >= least, added).otherwise(state["spans"]).alias("spans"))

    def length(stretch):
        return F.aggregate(stretch, zero, lambda n, x: n + F.char_length(x["gap"]) + F.coalesce(F.char_length(x["hit"]), F.lit(0)))

    def further(state, stretch):
        return F.struct((state["at"] + length(stretch)).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def spans(stretches):
        begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(stretches, begin, further, lambda state: state["starts"])
        return F.flatten(F.zip_with(stretches, starts, lambda stretch, at: F.aggregate(
            stretch, F.struct(at.alias("at"), F.array().cast(_SPAN).alias("spans")), step, lambda state: state["spans"])))

    cut = _bound(steps, lambda whole: F.transform(F.sequence(F.lit(1), F.size(whole), F.lit(STRETCH)), lambda i: F.slice(whole, i, STRETCH)))
    return F.when(F.size(hits) > 0, _bound(cut, spans)).otherwise(F.array().cast(_SPAN))


def _meets(spans: Column, x: Column) -> Column:
    """Whether a span of one kind (in order, apart from each other) overlaps ``x``: the first that ends after the start of ``x`` must start before its end."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1.0))).cast("int"))

    def middle(at):
        return F.shiftright(at["low"] + at["high"], 1)

    def halve(at, _):
        beyond = F.get(spans, middle(at))["e"] > x["s"]
        low = F.when((at["low"] < at["high"]) & ~beyond, middle(at) + 1).otherwise(at["low"])
        high = F.when((at["low"] < at["high"]) & beyond, middle(at)).otherwise(at["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    first = F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve, lambda at: at["low"])
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, first)["s"] < x["e"], F.lit(False))


def _weight(count: Column) -> Column:
    """c * log2(c), the share of a character with that count."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(chars: Column, width: int = WINDOW) -> Column:
    """Largest entropy, in bits, of ``width`` consecutive entries of ``chars``.

    With S the sum of c * log2(c) over the counts in a window, its entropy is log2(width) - S / width.
    S changes only by the terms of the character that leaves and of the one that enters.
    """
    return _bound(chars, lambda chars: _largest(chars, width))


def _largest(chars: Column, width: int) -> Column:
    def count(i, first, last, of):
        return F.size(F.filter(F.slice(chars, first, last - first + 1), lambda c: c == F.element_at(chars, of)))

    def step(state, i):
        leaves = F.when(i > width, count(i, i - width, i - 1, F.greatest(i - width, F.lit(1)))).otherwise(F.lit(1))
        enters = count(i, F.greatest(i - width + 1, F.lit(1)), i - 1, i)
        total = state["s"] + _weight(leaves - 1) - _weight(leaves) + _weight(enters + 1) - _weight(enters)
        bits = F.lit(math.log2(width)) - total / width
        return F.struct(total.alias("s"), F.when(i >= width, F.greatest(state["best"], bits)).otherwise(state["best"]).alias("best"))

    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda state: state["best"])


def threshold(candidate: Column, classes=CLASSES) -> Column:
    """Bits that a window of a string of this class must reach; null where the class is never a secret."""
    least = F.lit(None).cast("double")
    for pattern, bits in reversed(classes):
        least = F.when(candidate.rlike(pattern), F.lit(bits).cast("double")).otherwise(least)
    return least


def is_secret(candidate: Column, classes=CLASSES, allowed=ALLOWED) -> Column:
    least = threshold(candidate, classes)
    suppressed = F.lit(False)
    for pattern in allowed:
        suppressed = suppressed | candidate.rlike(pattern)
    high = F.when(~suppressed & least.isNotNull(), window_entropy(F.split(candidate, "")) >= least)
    return F.coalesce(high, F.lit(False))


def scan(docs: DataFrame, classes=CLASSES, allowed=ALLOWED) -> DataFrame:
    """doc_id, counts of the kinds by pattern, the digest of their spans, and all spans as ``kind:start:end``."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        "doc_id", text.alias("t"),
        F.regexp_extract_all(text, F.lit(ASSIGN), 0).alias("assigned"),
        F.regexp_extract_all(text, F.lit(ASSIGN), 2).alias("values"),
        F.regexp_extract_all(text, F.lit(ACCESS), 0).alias("keys"),
        F.regexp_extract_all(text, F.lit(HEX), 0).alias("runs"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("candidates"),
    )
    flags = F.transform("candidates", lambda c: is_secret(c, classes, allowed).cast("int"))
    flagged = found.withColumn("flags", F.when(F.size("candidates") > 0, flags).otherwise(F.array().cast("array<int>")))

    def lengths(column):
        return F.transform(column, F.char_length)

    placed = flagged.select(
        "doc_id",
        _placed(F.col("t"), ASSIGN, F.col("assigned"), lengths("values"), 8, 0).alias("assign"),
        _placed(F.col("t"), ACCESS, F.col("keys"), lengths("keys"), 16, 1).alias("access"),
        _placed(F.col("t"), HEX, F.col("runs"), lengths("runs"), 32, 2).alias("hex"),
        _placed(F.col("t"), CANDIDATE, F.when(F.array_max("flags") == 1, F.col("candidates")).otherwise(F.array().cast("array<string>")), F.col("flags"), 1, 3).alias("entropy"),
    )

    def shown(spans):
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"], x["e"])), ",")

    def ordered(*kinds):
        return F.array_sort(F.transform(F.concat(*kinds), lambda x: F.struct(x["s"], x["kind"], x["e"])))

    # A candidate that a pattern has found as well is listed once.
    base = placed.withColumn("base", ordered("assign", "access", "hex")).withColumn(
        "entropy", F.filter("entropy", lambda x: ~(_meets(F.col("assign"), x) | _meets(F.col("access"), x) | _meets(F.col("hex"), x)))
    )
    listed = base.withColumn("all", F.when(F.size("entropy") > 0, F.array_sort(F.concat("base", F.transform("entropy", lambda x: F.struct(x["s"], x["kind"], x["e"]))))).otherwise(F.col("base")))
    return listed.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("all")).alias("spans"), F.size("entropy").cast("long").alias("n_entropy"),
    )
