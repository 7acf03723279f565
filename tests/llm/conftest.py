import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = "The quick brown fox jumps over the lazy dog near the river bank today. " * 4000
    rows = [
        (1, "The cat sat on the mat and looked at the dog in the yard.", "en", "s", 57, 0.1, "x", "y", 1),
        (1, "The cat sat on the mat and looked at the dog in the yard.", "en", "s", 57, 0.1, "x", "y", 1),
        (2, "The cat sat on the mat and looked at the dog in the yard.", None, None, None, None, None, None, None),
        (3, None, "en", "s", 0, 0.1, "x", "y", 1),
        (4, "", "fr", "s", 0, 0.1, "x", "y", 1),
        (5, "12 34 !!", "de", "s", 8, 0.1, "x", "y", 1),
        (6, long_text, "en", "s", len(long_text), 0.1, "x", "y", 1),
        (7, long_text, "en", "s", len(long_text), 0.1, "x", "y", 1),
        (None, "Le chat est sur la table et regarde le chien dans la cour é.", "fr", "s", 3, 0.1, "x", "y", 1),
        (8, "a" * 3000, None, "s", 3000, 0.1, "x", "y", 1),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, "
              "digest string, item long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def write_table(spark, tmp_path_factory):
    """Write frames as <name>.parquet into a folder that queries can read."""
    def write(**frames):
        base = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(f"{base}/{name}.parquet")
        return base
    return write
