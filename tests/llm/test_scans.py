"""Quality ledger, personal data and secrets against plain re-computations of their definitions."""

import hashlib
import random
import re
import string
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagespine.llm import pii, quality, secrets


def texts_of(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in df.select("doc_id", "text").collect())


def by_text(df, result):
    """Result rows sorted like ``texts_of``; rows with one id have one text in these tables."""
    return sorted(result.collect(), key=lambda r: r.doc_id if r.doc_id is not None else -1)


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def luhn(digits):
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(int(c) for c in reversed(digits)))
    return total % 10 == 0


def plain_pii(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m[0].split("."))) <= 255),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text) if good(m)] for k, (p, good) in rules.items()}


def plain_secrets(text):
    rules = [
        (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    found = [(m.start(), k, m.end()) for k, (p, good) in enumerate(rules) for m in re.finditer(p, text) if good(m)]
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(found)]


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


@pytest.fixture(params=["odd_documents", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_pii_base_kinds(docs):
    for (_, text), row in zip(texts_of(docs), by_text(docs, pii.scan(docs)), strict=True):
        plain = plain_pii(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(plain[k]) for k in pii.KINDS[:4]], text[:300]
        base = sum(plain.values(), [])
        assert row.base_sha256 == digest(base)
        assert row.spans.startswith(",".join(base))


def test_pii_cues():
    found = pii.spans_of("IBAN: DE89 3704 0044 0532 0130 00, ssn 123-45-6789, acct no. 12345678, ftp://u:pw1@h.org iban DE00 3704 0044 0532 0130 00")
    assert [len(found[k]) for k in ("iban", "ssn", "account", "login")] == [1, 1, 1, 1]
    assert not any(pii.spans_of("a discount 123456 for accounts of compte rendu 2020, bassn 123-45-6789").values())


def test_pii_cues_in_any_case():
    for text in ("Social Security Number: 123-45-6789", "SOCIAL security 123-45-6789", "É sSn No. 123-45-6789"):
        assert pii.spans_of(text)["ssn"] == [(len(text) - 11, len(text))]
    assert pii.spans_of("İ IbAn DE89 3704 0044 0532 0130 00")["iban"] == [(7, 34)]
    assert pii.spans_of("AcCount NO. 12345678")["account"] == [(12, 20)]


def test_secrets_base_kinds(docs):
    for (_, text), row in zip(texts_of(docs), by_text(docs, secrets.scan(docs)), strict=True):
        plain = plain_secrets(text)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for k, *_ in plain) for kind in secrets.KINDS[:3]]
        base = [":".join(map(str, x)) for x in plain]
        assert row.base_sha256 == digest(base)
        assert set(base) <= set(row.spans.split(",")) | {""}
        assert row.n_entropy == row.spans.count("entropy")


def test_entropy_of_windows(spark):
    import math
    strings = ["aaaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz0123", "aabbccddeeaabbccddeeffgg", "abc"]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    got = [r[0] for r in df.select(secrets.window_entropy(F.split("s", ""))).collect()]
    for s, value in zip(strings, got, strict=True):
        windows = [Counter(s[i : i + 20]) for i in range(len(s) - 19)]
        assert value == pytest.approx(max([-sum(c / 20 * math.log2(c / 20) for c in w.values()) for w in windows], default=0), abs=1e-9)


def test_long_candidates_and_many_hits(spark):
    blob = hashlib.sha512(b"x").hexdigest().upper() * 200
    texts = [blob, "token=abcdefgh1 " * 3000, "xy1" * 5_000, ("a" * 60 + "_1x ") * 50]
    rows = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert rows[0].spans == f"entropy:0:{len(blob)}"
    assert rows[1].n_assign == 3000 and rows[1].n_entropy == 0
    assert rows[2].spans == "" and rows[3].n_entropy == 0


def test_entropy_kind_and_allow_list(spark):
    texts = ["key sk9Qz81LmX02PqRt77vWaBcDe end", "id 123e4567-e89b-12d3-a456-426614174000", "order 12345678901234567890123", "EXAMPLEsk9Qz81LmX02PqRt77vW", "wort Donaudampfschifffahrtsgesellschaft2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.spans for r in secrets.scan(docs).orderBy("doc_id").collect()] == ["entropy:4:29", "", "", "", ""]


def test_keys_without_digits(spark):
    names = ["getUserNameFromDatabaseConnection", "parseHTTPResponseHeaders", "/usr/local/share/SomeProject/FileName", "iPhoneAppStoreConnectApi",
             "Donaudampfschifffahrtsgesellschaft", "state-of-the-art-and-so-forth", "MAX_LENGTH_OF_ALL_NAMES", "SomeParameterName=SomeOtherValue", "x" * 5_000]
    texts = ["key qXvTbhLmPzRtKwNcYfGd end", "key qXvTbhLmPzRtKwNcYfGd7 end", " ".join(names)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.spans for r in secrets.scan(docs).orderBy("doc_id").collect()] == ["entropy:4:24", "entropy:4:25", ""]


def test_time_grows_with_the_hits_only(spark):
    """Every value is a candidate for entropy too, between candidates that no pattern finds."""
    draw = random.Random(3)

    def key():
        return "".join(draw.choices(string.ascii_letters + string.digits, k=24))

    text = " ".join(f"token={key()} {key()}" for _ in range(40_000))
    began = time.monotonic()
    row = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert time.monotonic() - began < 60
    plain = plain_secrets(text)
    assert row.n_assign == 40_000 and row.base_sha256 == digest([":".join(map(str, x)) for x in plain])
    spans = sorted((int(s), int(e), kind) for kind, s, e in (x.split(":") for x in row.spans.split(",")))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert row.n_entropy == len(spans) - 40_000 > 30_000


def test_overlaps_by_halving(spark):
    """Against every span, for all places around spans that touch and that lie apart."""
    spans = [(2, 5), (5, 9), (12, 13), (20, 30)]
    for n in range(len(spans) + 1):
        list_of = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in spans[:n]]).cast("array<struct<s: bigint, e: bigint>>")
        places = [(s, e) for s in range(33) for e in range(s + 1, 34)]
        df = spark.createDataFrame(places, "s long, e long").select("s", "e", secrets._meets(list_of, F.struct("s", "e")).alias("meets"))
        assert all(r.meets == any(s < r.e and r.s < e for s, e in spans[:n]) for r in df.collect())


def test_secrets_run_without_python(documents, capsys):
    secrets.scan(documents).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_quality_measures(docs):
    rows = by_text(docs, quality.ledger(docs))
    for (_, text), row in zip(texts_of(docs), rows, strict=True):
        n, chars, symbols, again, repeated = plain_quality(text)
        m = row.measures
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == (n, chars, symbols, again, repeated)
        failed = n < 50 or 100 * repeated > 50 * n
        assert bool(row.failures & quality.mask("base")) == failed


def test_quality_of_other_scripts(spark):
    cyrillic = " ".join(f"слово{c}{d} текст" for c in "абвгдежз" for d in "клмноп")
    chinese = " ".join("天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往" + chr(0x4E00 + i) * 9 for i in range(80))
    shout = " ".join(f"BUY{c}{d} NOW" for c in "ABCDEFGH" for d in "KLMNOP")
    texts = [cyrillic + " NATO COVID-19", chinese + " NATO", shout, shout + " é", " ".join(map(str, range(60))) + " A", "".join(chr(97 + i % 26) for i in range(3000)) + " b" * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = [n for n, _ in quality.RULES]
    bits = {r.doc_id: {n for i, n in enumerate(names) if r.failures >> i & 1} for r in quality.ledger(docs).collect()}
    assert [bits[0], bits[1]] == [set(), set()]
    assert "shouting" in bits[2] & bits[3]
    assert "shouting" not in bits[4]
    assert "word_length" in bits[5]
    assert {r.doc_id for r in quality.filtered(docs).collect()} >= {0, 1}


def test_quality_policies_and_ablation(documents):
    book = quality.ledger(documents)
    bits = [r.failures for r in book.collect()]
    whole = quality.mask("v1")
    assert quality.filtered(documents).count() == sum(b & whole == 0 for b in bits)
    for row in quality.ablation(book).collect():
        bit = 1 << [n for n, _ in quality.RULES].index(row.rule)
        assert (row.failed, row.failed_alone, row.kept_without) == (
            sum(b & bit > 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))


def test_quality_keeps_columns(odd_documents):
    kept = quality.filtered(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {r.doc_id for r in kept.collect()} == {4, None}


def test_quality_agrees_with_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality.filtered(documents).select("doc_id", F.lit(1).alias("k"))
    rows = labels.join(kept, "doc_id", "left").join(documents, "doc_id").filter("size(split(text, ' ')) >= 60").collect()
    agree = sum((r.k or 0) == r.quality for r in rows)
    assert agree >= 0.95 * len(rows)


@pytest.mark.parametrize("scan", [pii.scan, secrets.scan, quality.ledger])
def test_empty_table(no_documents, scan):
    assert scan(no_documents).count() == 0


def test_quality_sql_holds_todays_rules(spark, odd_documents, monkeypatch):
    """The SQL counterpart on scripts that the given tables lack."""
    import duckdb

    from pagespine.llm import oracles, queries

    texts = [
        " ".join(f"слово{c}{d} текст" for c in "абвгдежз" for d in "клмноп") + " NATO COVID-19", "天地玄黃宇宙洪荒日月盈昃" * 60 + " NATO" * 49,
        " ".join(f"BUY{c}{d} NOW" for c in "ABCDEFGH" for d in "KLMNOP"), "ภาษาไทย" * 300 + " x" * 50, "x" * 3000 + " y" * 50, "Ωμέγα " * 60 + "A" * 19,
    ]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    documents = odd_documents.select("doc_id", "text").dropDuplicates(["doc_id"]).unionByName(more)  # the SQL tells rows apart by id
    monkeypatch.setattr(queries, "_table", lambda *_: documents)
    found = queries.op10_quality_rules(spark, "")
    duck, frame = duckdb.connect(), documents.toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    duck.register("documents", frame)
    wanted = duck.execute(oracles.ORACLES["op10_quality_rules"]).fetchall()
    names = [c[0] for c in duck.description]
    ours = {tuple(r[n] for n in names) for r in found.collect() if r.doc_id is not None}
    assert ours == {row for row in wanted if row[0] is not None}
