"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
failure bit per rule; policies are sets of rules, applied to the stored bits, so that a
new policy or an ablation never reads a text again.

Cases: a null or empty text has no words (all measurements 0, fails ``few_words``). Null
ids and repeated rows stay, one ledger row per input row. An empty table gives an empty
ledger. Further columns of the input are ignored by ``ledger`` and kept by ``filtered``.
"""

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagespine.llm.texts import fresh, over_texts

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
    "n_letters long, n_upper long, n_digits long, n_all_letters long, n_unspaced long"
)

#: Rules in the order of their bits: name, and when a document fails. Append only; bits are stored.
#: Letters and capitals are ASCII; ``n_all_letters`` are those of every script, ``n_unspaced`` those of scripts without spaces between words.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_upper > n_all_letters and n_letters >= 20"),
    ("word_length", "( word_chars < 2 * n_words OR word_chars > 20 * n_words ) and 2 * n_unspaced <= n_all_letters"),
    ("digits", "10 * n_digits > 6 * word_chars"),
)

#: Versions of the policy: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}

_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = _UPPER + _UPPER.lower()
_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")
#: Thai, Lao, Tibetan, Burmese, Khmer, Tai, Balinese and Javanese, kana, bopomofo, Yi and Chinese characters.
UNSPACED = (
    "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\ua980-\ua9df\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9d\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
_UNSPACED = re.compile(f"[{UNSPACED}]")


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def _beyond_ascii(text: str) -> tuple:
    """Letters outside ASCII, and those of them in scripts without spaces between words."""
    if text.isascii():
        return 0, 0
    letters = [(c, n) for c, n in Counter("".join(_BEYOND_ASCII.findall(text))).items() if c.isalpha()]
    return sum(n for _, n in letters), sum(n for c, n in letters if _UNSPACED.match(c))


def _repeated(words: list) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, marks = Counter(windows), bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            marks[i : i + 3] = b"\x01\x01\x01"
    return sum(marks)


def measure(texts: list) -> list:
    """Measurements of each text; bytes are split at exactly the six ASCII white space characters."""
    rows = []
    for text in texts:
        text = text or ""
        data = text.encode()
        words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
        letters, (beyond, unspaced) = _count(data, _LETTERS), _beyond_ascii(text)
        rows.append((
            len(words), len(text) - _count(data, _SPACE), _count(data, _SYMBOLS), len(lines), len(lines) - len(set(lines)),
            _repeated(words), letters, _count(data, _UPPER), _count(data, _DIGITS), letters + beyond, unspaced,
        ))
    return rows


def failure_bits(rules=RULES, of: str = "measures") -> Column:
    """One bit per rule, set where the document fails it."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(_qualified(fails, of)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def _qualified(condition: str, of: str) -> str:
    names = {part.split()[0] for part in MEASURES.split(", ")}
    return " ".join(f"{of}.{word}" if word in names else word for word in condition.split())


def mask(policy: str = "v1", rules=RULES, policies=POLICIES) -> int:
    names = [name for name, _ in rules]
    return sum(1 << names.index(name) for name in policies[policy])


def passes(bits: Column, policy: str = "v1", rules=RULES, policies=POLICIES) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy, rules, policies)).cast("long")) == 0


def ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, ``measures`` and ``failures`` (bits), one row per row of ``docs``."""
    measured = docs.select("doc_id", over_texts(measure, MEASURES)("text").alias("measures"))
    return measured.withColumn("failures", failure_bits(rules))


def filtered(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    name = fresh(docs, "measures")
    kept = docs.withColumn(name, over_texts(measure, MEASURES)("text"))
    return kept.filter(passes(failure_bits(of=name), policy)).drop(name)


def ablation(book: DataFrame, policy: str = "v1", rules=RULES, policies=POLICIES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that pass the policy without it.

    Documents are first counted by their bits, so the rest works on a few rows however many documents there are.
    """
    chosen, whole = policies[policy], mask(policy, rules, policies)
    names = [name for name, _ in rules]
    bit = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).cast("long").alias("bit")) for n in chosen]))
    counted = book.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).count()
    each = counted.select("bits", "count", bit.alias("r")).select("bits", "count", "r.*")

    def total(condition):
        return F.sum(F.when(condition, F.col("count")).otherwise(0))

    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )
