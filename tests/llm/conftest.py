import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with every odd case: nulls, empty and long texts, repeated
    rows, equal ids, ties, and further columns whose names operators use."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    base = "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf who sleeps " * 3
    texts = [
        (0, base + "zero"), (1, base + "one"), (2, "unlike all others, this text has its own words only"), (3, None), (4, ""), (5, " \t\n "),
        (6, "one"), (7, "one"), (8, "two words"), (None, "no id at all but words"), (None, None), (9, long), (10, long + " tail"),
        (11, "Ünïcödé ñandú ÀÉ çà и мир 漢字 🙂 " * 12), (11, "same id, other text"), (12, "row twice " * 20), (12, "row twice " * 20),
        (13, "a\nb\na\nb\n\n c"), (14, "x" * 20_000), (15, base + "zero"),
    ]
    rows = [Row(doc_id=i, text=t, lang=None if k % 3 else "en", source="s", n_chars=None, node="n", _text="t", _hash=1, _row="r", kept=True, at=5) for k, (i, t) in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, _text string, _hash bigint, _row string, kept boolean, at bigint"
    return spark.createDataFrame(rows, schema)


def by_row(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
