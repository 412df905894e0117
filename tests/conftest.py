import pytest

from pagespine.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4)
    yield session
    session.stop()


LINE_SCHEMA = (
    "document_name string, page_number int, line_no int, text string, fontname string, fontsize double, "
    "x0 double, y0 double, x1 double, y1 double, page_width double, page_height double"
)


@pytest.fixture
def make_lines(spark):
    """Lines from (document, page, line, text, font, size) with a place derived from the line number."""
    def make(rows):
        full = [
            (d, p, n, t, f, s, 72.0 + n, 700.0 - 20 * n, 200.0 + n, 712.0 - 20 * n, 612.0, 792.0)
            for d, p, n, t, f, s in rows
        ]
        return spark.createDataFrame(full, LINE_SCHEMA)

    return make
