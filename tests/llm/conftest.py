import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0, extra=False):
    """A documents table of these texts; with ``extra``, columns whose names operators also make."""
    rows = [(first + i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        frame = frame.withColumns({n: F.lit("old") for n in (
            "score", "lang_pred", "predicted", "ids", "secrets", "fp", "component_id", "position", "copies", "Root")})
    return frame


LONG = "The quick brown fox, jumps over it. " * 3_000
ODD = [None, "", " ", "\n\n", "...", "x", "Ünïcode ▁ ﬁ́ 日本語 \U0001F600\x1c", "a  b   c", LONG, "same text here", "same text here",
       "❤️ ⚠️", "\u0301\u0302", "\u200d1️⃣"]
