"""Awkward documents shared by the tests: nulls, empty and long texts, ties, repeats, clashing extra columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ("the of and thion erha ndst ingre thwh onat esly der und heit ung ver keit le ouai menteux éaux de que ciónas ñado "
         "los idiot 12 3,450 it's we'll I'd").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts():
    rng = random.Random(4)
    long_text = "\n".join(sentence(rng, 40) for _ in range(150))
    return [None, "", " ", "\n\t \r", "a", "A  b\t\nc", "A b c", "1234 ...", "x" * 5000, " " * 300 + "y", "it's we'll they'd'll 'l'l",
            "naïve café — “quotes”…  nbsp  em", "日本語のテキスト 漢字", "🙂🙂 emoji \U0001f468‍\U0001f469", "bad\x1c\x1d\x85sep",
            "before <|endoftext|> after<|endoftext|>", "՘꟎ new letters", "tab\tand\r\nline  end \n", long_text, long_text, long_text + " tail",
            sentence(rng, 60), sentence(rng, 3), "one two three four", "one two three four five"]


def awkward(spark):
    """Rows with all of these texts; ids repeat, one is NULL, and every column holds a NULL somewhere."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"src{i % 3}", None) for i, t in enumerate(texts())]
    rows += [(3, "a", "en", "src1", 1), (3, "a", "en", "src1", 1), (None, "A b c", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(docs):
    """The same with columns that operators use inside."""
    names = ["row", "digest", "keep_id", "copies", "label", "score", "predicted", "held_out", "set_id", "n", "size", "sketch", "component",
             "component_id", "line", "position", "site", "block", "packed", "edited", "start", "length", "word", "terms", "model", "chunk", "ids"]
    return docs.withColumns({n: F.lit("clash") for n in names})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def marks(spark, docs, label="toxic"):
    """Labels for every other row."""
    return docs.filter("doc_id IS NOT NULL").select("doc_id", (F.col("doc_id") % 2).cast("int").alias(label)).distinct()
