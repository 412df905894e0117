import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagespine.operators import clusters, corpus_model, outline, postprocess, rules, spread, style

SCHEMA = (
    "document_name string, seq bigint, page_number int, text string, fontsize double, predicted_label string, "
    "features struct<is_bold:int,y_coordinate:double,word_count:int>"
)


@pytest.fixture
def make_blocks(spark):
    """Blocks from (document, page, text, label) and options size, bold, y."""
    def make(rows):
        full = []
        for seq, (doc, page, text, label, *rest) in enumerate(rows):
            size, bold, y = (*rest, *(11.0, 0, 700.0 - seq)[len(rest):])
            full.append((doc, seq, page, text, size, label, (bold, y, len(text.split()))))
        return spark.createDataFrame(full, SCHEMA)

    return make


def labels(df):
    return [r.predicted_label for r in df.orderBy("document_name", "seq").collect()]


def test_uniform_style(make_blocks):
    rows = [("nine", 0, "t", None)] * 9 + [("flat", 0, "t", None)] * 10
    rows += [("two", 0, "t", None, s) for s in (9.0, 20.0) * 5] + [("many", 0, "t", None, s) for s in (9.0, 14.0, 20.0) * 4]
    rows += [("near", 0, "t", None, s) for s in (11.0, 11.1, 11.2) * 4]
    verdict = {r.document_name: r.is_uniform for r in style.style_stats(make_blocks(rows)).collect()}
    assert verdict == {"nine": False, "flat": True, "two": True, "many": False, "near": True}


def test_rule_labels(make_blocks):
    blocks = make_blocks([
        ("d", 0, "A short title", None, 11.0, 0, 700.0),
        ("d", 0, "***", None, 11.0, 0, 690.0),
        ("d", 0, "1.2 Scope", None, 11.0, 1, 685.0),
        ("d", 0, "Plain " * 30, None, 11.0, 0, 680.0),
        ("d", 1, "BOLD CAPS", None, 11.0, 1, 400.0),
        ("d", 1, "Above it", None, 11.0, 0, 500.0),
        ("d", 1, "same height", None, 11.0, 0, 400.0),
    ])
    got = {r.text.strip()[:12]: (r.predicted_label, r.features.space_before) for r in rules.rule_labels(blocks).collect()}
    assert got == {
        "A short titl": ("Title", 100.0), "1.2 Scope": ("H1", 5.0), "Plain Plain ": ("Body", 5.0),
        "Above it": ("H3", 100.0), "BOLD CAPS": ("H1", 100.0), "same height": ("Body", 0.0),
    }


def test_noise_in_front_leaves_no_title(make_blocks):
    first_is_noise = make_blocks([("d", 0, "***", None), ("d", 0, "Next", None)])
    assert labels(rules.rule_labels(first_is_noise)) == ["Body"]
    assert rules.rule_labels(make_blocks([("d", 0, "***", None), ("d", 0, "Page 2", None)])).isEmpty()


def test_corrections(make_blocks):
    long = "Word " * 16
    blocks = make_blocks([
        ("d", 0, "Dec 2020", "Title"), ("d", 0, long, "Title"), ("d", 0, "Second", "Title"), ("d", 0, "1.1 Part", "Body"),
        ("d", 0, "lower", "H2"), ("d", 0, "3 " + long, "Body"), ("d", 0, "Kept", "H3"),
        ("d", 0, "Head", "H1"), ("d", 1, " Head", "H1"), ("d", 2, "Head", "Title"), ("e", 0, "Head", "Title"),
        ("e", 1, "Twice", "H1"), ("e", 1, "Twice", "H1"), ("e", 2, "Twice", "H1"),
    ])
    once = postprocess.post_process(blocks)
    assert labels(once) == [
        "Body", "Body", "H1", "H2", "Body", "Body", "H3", "Body", "Body", "Body", "Title", "H1", "H1", "H1",
    ]


def test_corrections_twice_change_no_headings(make_blocks):
    blocks = make_blocks([("d", 0, "A title", "Title"), ("d", 0, "Part", "H1"), ("d", 1, "2.1 Sub", "H3")])
    once = postprocess.post_process(blocks)
    assert labels(postprocess.post_process(once)) == labels(once) == ["Title", "H1", "H2"]


def test_outline(make_blocks):
    blocks = make_blocks([
        ("d", 1, "Later", "H2"), ("d", 0, "Sooner", "H1"), ("d", 0, "The\ntitle", "Title"), ("d", 9, "Far", "H3"), ("e", 0, "text", "Body"),
    ])
    rows = {r.document_name: (r.title, [tuple(i) for i in r.outline]) for r in outline.document_outline(blocks).collect()}
    assert rows == {"d": ("The\ntitle", [("H1", "Sooner", 0), ("H2", "Later", 1), ("H3", "Far", 9)]), "e": ("Untitled Document", [])}
    assert [r.document_name for r in outline.empty_outlines(outline.document_outline(blocks)).collect()] == ["e"]


def test_every_document_has_a_title_row(make_blocks):
    blocks = make_blocks([
        ("d", 1, "Second", "Title"), ("d", 0, "First", "Title"), ("d", 0, "Part", "H1"), ("e", 0, "text", "Body"), ("f", 0, "Head", "H1"),
    ])
    titles = {r.document_name: r.title for r in outline.document_titles(blocks).collect()}
    assert titles == {"d": "First", "e": "Untitled Document", "f": "Untitled Document"}


@pytest.mark.parametrize("pages", [[0, 5000], [5000]])
def test_outline_is_one_row_however_far_its_pages_lie(make_blocks, pages):
    made = outline.document_outline(make_blocks([("d", page, f"Part {page}", "H1") for page in pages]))
    (row,) = made.collect()
    assert [i.page for i in row.outline] == pages
    assert [r.output_name for r in outline.outline_json(made).collect()] == ["d_output.json"]


def test_upper_edge_orders_outline_when_present(make_blocks):
    blocks = make_blocks([("d", 0, "Low", "H1"), ("d", 0, "High", "H1")]).withColumn("y0_top", F.col("seq") * 10.0)
    assert [i.text for i in outline.document_outline(blocks).first().outline] == ["High", "Low"]


def test_outline_json_keeps_letters(make_blocks):
    made = outline.document_outline(make_blocks([("d", 0, "Überblick 日本", "H1")]))
    row = outline.outline_json(made).first()
    assert row.output_name == "d_output.json"
    assert row.value == '{"title":"Untitled Document","outline":[{"level":"H1","text":"Überblick 日本","page":0}]}'


def vectors(spark, documents):
    rows = [
        (doc, page, seq, float(v[0]), [float(x) for x in v])
        for doc, points in documents.items() for seq, v in enumerate(points) for page in (seq // 3,)
    ]
    return spark.createDataFrame(rows, "document_name string, page_number int, seq bigint, fontsize double, feature_vector array<double>")


def random_documents():
    rng = np.random.default_rng(5)
    sizes = {"one": 1, "four": 4, "five": 5, "mid": 30, "big": 120}
    documents = {name: rng.integers(0, 6, (n, 7)) for name, n in sizes.items()}
    documents["same"] = np.ones((8, 7))
    documents["two"] = np.repeat([[9.0] * 7, [1.0] * 7], 6, axis=0)
    return documents


def brute_force(points, k=5, more_rounds=0):
    """Whole-number Lloyd, point by point."""
    points = np.asarray(points, dtype=float)
    std = np.round(points.std(axis=0), 9)
    z = np.floor((points - points.mean(axis=0)) / np.where(std == 0, 1, std) * 100000 + 0.5)
    k = min(k, len(z))
    centers = [z[max(range(len(z)), key=lambda i: (points[i][0], -i))]]
    while len(centers) < k:
        far = [min(((p - c) ** 2).sum() for c in centers) for p in z]
        centers.append(z[max(range(len(z)), key=lambda i: (far[i], -i))])
    seen = []
    while True:
        labels = [min(range(k), key=lambda j: (((p - centers[j]) ** 2).sum(), j)) for p in z]
        state = np.array(centers).tobytes()
        if state in seen:
            more_rounds -= 1
            if more_rounds < 0:
                return labels
        seen.append(state)
        for j in range(k):
            members = z[[i for i, label in enumerate(labels) if label == j]]
            if len(members):
                centers[j] = np.floor(members.sum(axis=0) / len(members) + 0.5)


def by_document(df):
    out = {}
    for r in df.orderBy("document_name", "seq").collect():
        out.setdefault(r.document_name, []).append(r.cluster_label)
    return out


@pytest.mark.parametrize("way", ["small", "large, broadcast", "large, by bucket", "mixed"])
def test_kmeans_ways_agree_with_brute_force(spark, monkeypatch, way):
    documents = random_documents()
    monkeypatch.setattr(spread, "PAGES_PER_BUCKET", 2)
    scaled = clusters.scaled_features(vectors(spark, documents))
    if way == "small":
        got = clusters.cluster_small(scaled, 5)
    elif way == "mixed":
        got = clusters.cluster_scaled(scaled, task_blocks=20)
    else:
        got = clusters.LargeDocumentKMeans(scaled, broadcast_bytes=1 << 20 if "broadcast" in way else 0).fit()
    assert by_document(got) == {name: brute_force(points) for name, points in documents.items()}


def test_one_more_round_moves_nothing():
    for points in random_documents().values():
        assert brute_force(points) == brute_force(points, more_rounds=1)


def test_more_rounds_than_ten(spark):
    """Points of even spacing, where the border between two clusters wanders for long; both ways go on to the end."""
    points = np.zeros((160, 7))
    points[:, 0] = np.arange(160) ** 1.5
    points[:, 4] = np.arange(160) % 7
    scaled = clusters.scaled_features(vectors(spark, {"long": points}))
    small, large = clusters.cluster_small(scaled, 5), clusters.LargeDocumentKMeans(scaled).fit()
    assert by_document(small) == by_document(large) == {"long": brute_force(points)}
    assert small.filter("NOT settled").isEmpty() and large.filter("NOT settled").isEmpty()


def test_rounds_are_planned_by_the_size_of_their_centers(spark):
    """The estimate of joined plans would square with every round."""
    documents = random_documents()
    large = clusters.LargeDocumentKMeans(clusters.scaled_features(vectors(spark, documents)), broadcast_bytes=0)
    seeds = large.seeds()
    for centers in (seeds, large.settle(seeds)):
        assert int(str(centers._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 20


def test_cluster_labels_rank_by_size(spark):
    rows = [("d", 0, i, size, k) for i, (size, k) in enumerate([(9.0, 0), (9.0, 1), (20.0, 2), (12.0, 3), (10.0, 4), (8.0, 5)])]
    df = spark.createDataFrame(rows, "document_name string, page_number int, seq bigint, fontsize double, cluster_label int")
    assert labels(clusters.cluster_labels(df)) == ["H3", "Body", "Title", "H1", "H2", "Body"]


def test_one_model_for_all(spark, tmp_path):
    draw = random.Random(8)
    rows = [(f"d{i % 4}", 0, i, [draw.choice((1.0, 9.0, 30.0)), *[draw.random() for _ in range(6)]], 9.0) for i in range(200)]
    blocks = spark.createDataFrame(rows, "document_name string, page_number int, seq bigint, feature_vector array<double>, fontsize double")
    points = corpus_model.with_points(blocks).cache()
    made = corpus_model.fit(points, 3)
    corpus_model.save(made, str(tmp_path / "model"))
    found = corpus_model.load(str(tmp_path / "model"))
    labels = {(r.document_name, r.seq): r.corpus_cluster for r in found.transform(points).collect()}
    assert labels == {(r.document_name, r.seq): r.corpus_cluster for r in made.transform(points).collect()}
    sizes = corpus_model.cluster_sizes(found, points).collect()
    assert sum(r.n_blocks for r in sizes) == 200 and all(r.n_documents <= 4 for r in sizes)
    # The summary tells the cost before the last move of the centers, which can only lower it.
    assert 0.9 * made.stages[-1].summary.trainingCost < sum(r.cost for r in sizes) <= made.stages[-1].summary.trainingCost + 0.01
    again = corpus_model.fit(points, 3)
    assert [c.tolist() for c in again.stages[-1].clusterCenters()] == [c.tolist() for c in made.stages[-1].clusterCenters()]
