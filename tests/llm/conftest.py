import pytest


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every operator must take: nulls, empty and very long texts, ties, repeats."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, "   \n\t ", "de", None, 6),
        (None, "a text without an id", "en", "a", 20),
        (None, None, None, None, None),
        (6, long, "en", "b", len(long)),
        (7, "x", None, "b", 1),
        (8, "\U0001F600 日本語 ßü", "de", "b", 8),
        (9, long, "en", "b", len(long)),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same as a table, with extra columns whose names the operators use themselves."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, fp long, "
              "blob string, cuts string, found int, part int, ord long, simhash_id long, own_id long, gone_id long, "
              "toxic_score double, language string, digest long, held_out boolean")
    return spark.createDataFrame([(*r, 0.5, 1, "b", "c", 1, 2, 3, 4, 5, 6, 0.1, "l", 7, True) for r in odd_rows], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture
def table_dir(tmp_path, spark):
    """Write documents (and labels, benchmark) as a driver directory."""
    def write(docs, labels=(), items=()):
        spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in docs],
                              "doc_id long, text string, lang string, source string, n_chars long"
                              ).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)
    return write
