import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_help import odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with null ids and sources, a repeated row and columns named like results."""
    rows = [(i, t, f"s{i % 5}" if i % 11 else None, i % 3) for i, t in enumerate(odd_texts())]
    rows += [rows[9], rows[12], (None, "null id " * 30, None, None), (None, None, None, None)]
    names = "doc_id long, text string, source string"
    clash = ("n_words", "kept", "matches", "shard", "SLOT", "repeats", "target", "clean_text", "kept_text", "size", "start", "key", "id", "h", "fp")
    schema = names + "".join(f", {c} long" for c in clash)
    return spark.createDataFrame([r[:3] + (r[3],) * len(clash) for r in rows], schema).repartition(3).cache()
