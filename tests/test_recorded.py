"""Numbers and labels recorded from a run over one form; the texts are stand-ins of the same kind."""

import json

import pytest
from pyspark.sql import functions as F

from pagespine.operators import clusters, outline, postprocess, rules
from pagespine.operators.features import with_vectors
from pagespine.operators.traits import with_traits

# Font size, indentation, bold, height, offset from the centre, words, and the recorded seventh number.
VECTORS = [
    (11.67, 199.86, 1, 734.57, 21.03, 7, 17.126),
    (9.74, 70.02, 1, 704.06, 221.43, 3, 7.189),
    (9.74, 96.0, 0, 707.0, 101.49, 18, 9.856),
    (9.74, 70.02, 1, 632.19, 221.43, 1, 7.189),
    (9.74, 70.02, 0, 617.08, 140.44, 5, 7.189),
]

# Text, bold, height, words, and the recorded space above and label; None where the block is noise.
FORM = [
    ("Title of the form to fill in", 1, 734.57, 7, 100.0, "Title"),
    ("Name and more of the person who asks", 0, 707.0, 18, 27.57, "Body"),
    ("1.\n2.\n3.", 1, 704.06, 3, 2.94, "Body"),
    ("4.", 1, 632.19, 1, None, None),
    ("5.  Whether this or that", 0, 617.08, 5, 15.11, "H3"),
    ("6.", 1, 598.9, 1, None, None),
    ("Town as it stands in the book", 0, 598.9, 16, 0.0, "Body"),
    ("7.\n8.\n9.", 1, 574.95, 3, 23.95, "Body"),
    ("so whether a long question is met", 0, 569.14, 55, 5.81, "Body"),
    ("and which way by the shortest", 0, 426.82, 20, 142.32, "Body"),
    ("10.", 1, 423.82, 1, None, None),
    ("Name\nAge\nRelation\nNo\n1.\n2.\n3.\n4.\n5.\n6.", 1, 375.93, 10, 47.89, "H2"),
    ("11.\n12.", 1, 341.38, 2, 34.55, "Body"),
    ("Amount that is needed.\nCoins", 0, 278.86, 5, 62.52, "H3"),
    ("I declare what stands above and sign", 0, 243.16, 69, 35.7, "Body"),
    ("Date\nSignature of the person", 1, 161.01, 5, 82.15, "H1"),
]


def test_vectors(spark):
    rows = [(i, (size, left, bold, height, off, words)) for i, (size, left, bold, height, off, words, _) in enumerate(VECTORS)]
    kind = "struct<font_size: double, indentation: double, is_bold: int, y_coordinate: double, centering_offset: double, word_count: int>"
    made = with_vectors(spark.createDataFrame(rows, f"i int, features {kind}")).orderBy("i").collect()
    assert [r.feature_vector for r in made] == [[s, left, b, off, w, h, ratio] for s, left, b, h, off, w, ratio in VECTORS]


@pytest.fixture
def labelled(spark):
    rows = [("form", 0, i, text, (bold, height, words)) for i, (text, bold, height, words, _, _) in enumerate(FORM)]
    kind = "document_name string, page_number int, seq bigint, text string, features struct<is_bold: int, y_coordinate: double, word_count: int>"
    return rules.rule_labels(with_traits(spark.createDataFrame(rows, kind)))


def test_rule_labels_and_space(labelled):
    kept = {i: (space, label) for i, (*_, space, label) in enumerate(FORM) if label}
    made = postprocess.post_process(labelled).collect()
    assert {r.seq: r.predicted_label for r in made} == {i: label for i, (_, label) in kept.items()}
    for r in made:
        assert r.features.space_before == pytest.approx(kept[r.seq][0], abs=1e-6)


def test_outline(labelled):
    (row,) = outline.outline_json(outline.document_outline(postprocess.post_process(labelled))).collect()
    made = json.loads(row.value)
    assert made["title"] == FORM[0][0]
    assert [(i["level"], i["text"], i["page"]) for i in made["outline"]] == [(r[5], r[0], 0) for r in FORM if r[5] in ("H1", "H2", "H3")]


# Cluster and vector of each block of two clustered documents, as recorded.
INVITATION = [
    (4, [12.4, 32.65, 0, 47.39, 2, 238.26, 2.633]), (0, [12.4, 114.81, 1, 1.99, 2, 210.17, 9.259]), (0, [12.4, 81.08, 0, 2.11, 4, 196.25, 6.539]),
    (0, [9.4, 58.39, 0, 1.5, 6, 182.59, 6.212]), (2, [19.2, 29.49, 0, 0.14, 2, 159.27, 1.536]), (1, [7.2, 59.61, 0, 1.14, 26, 128.26, 8.279]),
    (2, [26.41, 33.42, 1, 7.07, 5, 80.12, 1.265]), (2, [23.41, 93.79, 0, 1.93, 1, 54.94, 4.006]),
]
FLYER = [
    (1, [28.01, 125.82, 1, 37.98, 5, 754.63, 4.492]), (0, [12.0, 80.33, 0, 6.07, 50, 702.56, 6.694]), (2, [14.01, 45.41, 0, 242.24, 1, 605.93, 3.241]),
    (0, [11.51, 39.68, 0, 115.46, 107, 581.19, 3.447]), (0, [15.31, 240.18, 0, 3.34, 2, 350.07, 15.688]), (4, [15.31, 117.18, 1, 126.36, 2, 324.25, 7.654]),
    (0, [11.01, 74.78, 0, 104.9, 66, 307.58, 6.792]), (3, [15.31, 351.72, 1, 119.61, 2, 324.25, 22.973]), (0, [11.01, 320.78, 0, 125.86, 103, 307.58, 29.135]),
    (1, [22.01, 182.11, 0, 0.87, 3, 744.09, 8.274]), (4, [12.0, 69.65, 1, 16.04, 13, 702.14, 5.804]), (2, [11.0, 36.32, 0, 267.75, 6, 638.57, 3.302]),
    (2, [11.0, 36.32, 0, 218.27, 18, 638.13, 3.302]), (2, [11.0, 36.32, 0, 267.75, 4, 517.02, 3.302]), (2, [11.0, 36.32, 0, 218.37, 13, 516.58, 3.302]),
    (0, [10.0, 156.32, 0, 109.03, 37, 639.86, 15.632]), (0, [11.0, 254.27, 0, 49.8, 9, 638.57, 23.115]), (0, [11.0, 275.13, 0, 22.36, 26, 638.13, 25.012]),
    (0, [10.0, 275.13, 0, 64.86, 23, 638.74, 27.513]), (3, [10.0, 403.14, 1, 128.51, 9, 458.67, 40.314]), (3, [10.0, 482.14, 0, 223.27, 36, 638.74, 48.214]),
    (4, [18.01, 229.62, 1, 1.37, 3, 311.62, 12.75]), (4, [11.01, 35.26, 1, 140.1, 16, 277.07, 3.203]), (0, [11.01, 35.26, 0, 1.07, 161, 277.07, 3.203]),
    (4, [12.01, 69.13, 1, 0.29, 13, 70.16, 5.756]),
]


def test_recorded_clusterings_are_settled(spark):
    """No block of theirs would move, and the seeds used here reach a lower inertia."""
    rows = [(name, 0, i, [float(x) for x in v], v[0], k) for name, table in (("invitation", INVITATION), ("flyer", FLYER)) for i, (k, v) in enumerate(table)]
    kind = "document_name string, page_number int, seq bigint, feature_vector array<double>, fontsize double, cluster_label int"
    given = spark.createDataFrame(rows, kind)
    stood = {r.document_name: r for r in clusters.clustering_state(given).collect()}
    assert {name: (r.n_blocks, r.n_clusters, r.n_moved) for name, r in stood.items()} == {"invitation": (8, 4, 0), "flyer": (25, 5, 0)}
    assert stood["invitation"].inertia == pytest.approx(16.16, abs=0.01) and stood["flyer"].inertia == pytest.approx(66.39, abs=0.01)
    own = clusters.cluster_blocks(given.drop("cluster_label"))
    reached = {r.document_name: r for r in clusters.clustering_state(own).collect()}
    assert all(reached[name].n_moved == 0 and reached[name].inertia <= stood[name].inertia for name in stood)
    # One block in a wrong cluster is seen.
    moved = given.withColumn("cluster_label", F.when(F.col("seq") == 5, 0).otherwise(F.col("cluster_label")))
    assert all(r.n_moved > 0 for r in clusters.clustering_state(moved.filter("document_name = 'flyer'")).collect())
