import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

WORDS = "amber birch cedar dune ember fjord glade heath inlet jetty knoll lagoon marsh nook oasis plain quarry reef steppe tundra".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties and repeated rows."""
    long = prose(1, 3000)
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, prose(2, 80)), (6, prose(2, 80)), (7, long), (8, long + " end"),
            (9, "línea ñandú 😀 " * 30), (9, "línea ñandú 😀 " * 30), (None, "no id"), (10, "a\n\nb\na")]
    return [(i, t, None if i == 4 else "en", None if i == 5 else "s", len(t or "")) for i, t in rows]


def docs_of(spark, rows, extra=True):
    df = spark.createDataFrame([(r[0], r[1], *(r[2:] or ("en", "s", len(r[1] or "")))) for r in rows], SCHEMA)
    if extra:  # extra columns whose names the operators use inside
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in ("key", "n", "c1", "items", "label", "score_", "ids")})
    return df
