"""Small documents with the cases that operators must survive."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, h long, score double"


def rows(n: int = 60, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioustrnlm") for _ in range(rng.randint(1, 9))) for _ in range(200)] + ["the", "of", "été", "Straße", "日本", "a"]
    out = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 20, 80, 300]))]
        out.append((i, " ".join(words).replace(" a ", "\n") + rng.choice(["", ".", "\n", "  x"])))
    out += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "x" * 5000), (1004, "one two three one two three one two three four"), (1005, out[7][1]), (1006, out[7][1])]
    out += [(1007, "the same words again " * 3000), (1008, out[3][1] + " extra"), (1009, "A\nA\nA\nB\n\n \nA"), (out[5][0], out[5][1]), (None, "no id here"), (1010, "one two three"), (1011, " odd\x0bspace\x1cnot space")]
    return out


def frame(spark: SparkSession, pairs=None) -> DataFrame:
    """The rows with null and clashing extra columns."""
    pairs = rows() if pairs is None else pairs
    return spark.createDataFrame([(i, t, ["en", "fr", None][(i or 0) % 3], None, len(t or ""), 7, 7, None) for i, t in pairs], SCHEMA)
