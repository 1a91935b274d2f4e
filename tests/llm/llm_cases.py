"""Small document tables with the awkward cases, shared by the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; an input may have them too.
CLASHES = ("shard", "ids", "start", "end", "same", "keys", "head_id", "own_same", "kinds", "low", "has", "n_lines", "kept_text", "of_id", "drop_lines", "score", "words", "copy")


def prose(seed: int, sentences: int, words: int = 12) -> str:
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("bcdfghklmnprst") + draw.choice("aeiou") for _ in range(draw.randrange(1, 4))) for _ in range(400)]
    out = []
    for _ in range(sentences):
        out.append(" ".join(draw.choice(vocabulary) for _ in range(words)).capitalize() + ".")
    return " ".join(out[: sentences // 2]) + "\n" + " ".join(out[sentences // 2 :])


LONG = prose(99, 2500)
ODD_TEXTS = [
    None, "", " ", "\n", "\n\n \t\n", "word", "Ünï cödé straße 漢字 ñ", "a  b\n c \n\ny z ", "x\r\ny\x0bz\x0c", " lead and trail ",
    "§ ~ ^ | @ `", "tab\tbetween\twords", "🙂 emoji 🙂🙂 text", "no-break space here", "A" * 3000, LONG, LONG, "İstanbul ǅ K",
]


def rows(texts: list, first: int = 0) -> list[tuple]:
    return [(first + i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


def table(spark, data: list[tuple], extra: bool = False):
    frame = spark.createDataFrame(data, COLUMNS)
    if extra:
        frame = spark.createDataFrame([(*r, *(f"{c}-{r[0]}" for c in CLASHES)) for r in data], T.StructType([*frame.schema.fields, *(T.StructField(c, T.StringType()) for c in CLASHES)]))
    return frame.repartition(3)


def odd(spark, extra: bool = False):
    """Every odd text, two rows without an id, one row twice, and two texts of one id."""
    data = rows(ODD_TEXTS)
    data += [(None, "no id here", None, None, None), (None, None, None, None, None), data[5], (3, "another text of id three", "en", None, 24)]
    return table(spark, data, extra), data
