"""Near duplicates: signatures and sets against their definitions, components against all pairs."""

import random
import re

import numpy as np
import pytest

from pagespine.llm import components, near_duplicates, shingles


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    """All pairs; rows are (id, text)."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(i, j) for ids in by_shingle.values() for i in ids for j in ids if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(s), least[find(i)], doc == least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, near_duplicates.scan(documents).collect())) == plain_components(rows)


def crowded(seed=2):
    """Copies, chains of near copies, and many texts around one passage, near the threshold and far from it."""
    draw = random.Random(seed)

    def words(n):
        return [f"w{draw.randrange(5000)}" for _ in range(n)]

    texts, passage = [], words(60)
    for share in (20, 40, 60, 80, 400):
        texts += [" ".join(passage + words(draw.randrange(share // 2, share))) for _ in range(30)]
    base = words(120)
    for _ in range(60):
        text = list(base)
        for _ in range(draw.randrange(4)):
            text[draw.randrange(120)] = words(1)[0]
        texts.append(" ".join(text))
    chain = words(100)
    for _ in range(25):
        chain = chain[4:] + words(4)
        texts.append(" ".join(chain).upper())
    texts += [texts[0]] * 20 + ["one two", "ONE  two", "one", "", None, " "]
    draw.shuffle(texts)
    return list(enumerate(texts, 100))


def test_crowded_buckets(spark):
    rows = crowded()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, near_duplicates.scan(docs).collect())) == plain_components(rows)
    kept = near_duplicates.deduplicated(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [doc for doc, _, _, keep in plain_components(rows) if keep]


def test_odd_documents(odd_documents):
    rows = near_duplicates.scan(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    prose = found[4][0]
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[4] == (prose, 4, True) and found[None] == (prose, 4, False) and found[5] == (1, 5, True)
    kept = near_duplicates.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, _, keep) in found.items() if keep)


def test_empty_table(no_documents):
    assert near_duplicates.scan(no_documents).count() == 0
    assert near_duplicates.deduplicated(no_documents).count() == 0


def test_sets():
    texts = ["a b c d e f a b c d e f", " X\ty\nz ", "", None, "é é é é é é", "a b c d", "x" * 3_000_000 + " y"] + ["lorem ipsum " * 500_000]
    assert [len(s) for s in shingles.shingle_sets(texts)] == [len(plain_set(t)) for t in texts]
    one, two = shingles.shingle_sets(["A b C d e f", "zz a B c d e"])
    assert len(np.intersect1d(one, two)) == 1
    assert (shingles.shingle_sets(["q r s t u"])[0] == shingles.shingle_sets(["filler " * 70_001 + "\n", "q r s t u"])[1]).all()


def test_common_elements():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, draw.choice([20, 300, 4000]), draw.integers(1, 90))) for _ in range(70)]
    plain = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (np.triu(near_duplicates._common(sets), 1) == np.triu(plain, 1)).all()


@pytest.mark.parametrize("nodes", [10, 1000])
def test_blocks_of_crowds(spark, monkeypatch, nodes):
    monkeypatch.setattr(near_duplicates, "BLOCK_NODES", nodes)
    monkeypatch.setattr(near_duplicates, "SMALL", 2)
    rows = crowded(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(map(tuple, near_duplicates.scan(docs).collect())) == plain_components(rows)


def test_signature_estimates_similarity():
    draw = np.random.default_rng(0)
    one = draw.integers(0, 2**63, 3000, np.uint64)
    other = np.concatenate([one[:2000], draw.integers(0, 2**63, 1000, np.uint64)])
    same = (shingles.signature(one, 1024) == shingles.signature(other, 1024)).mean()
    assert abs(same - 0.5) < 0.06
    shifted = shingles.signature(one, 8)
    plain = shingles._mix32((one >> np.uint64(32)).astype(np.uint32) ^ one.astype(np.uint32))
    assert [int(shingles._mix32(plain + np.uint32(k)).min()) for k in range(8)] == shifted.tolist()


@pytest.mark.parametrize("seed", [0, 1])
def test_contraction(spark, seed):
    draw = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(20)] + [tuple(draw.sample(range(200, 260), 2)) for _ in range(40)]
    draw.shuffle(edges)
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components.contracted(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == root
