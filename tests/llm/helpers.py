"""Small tables every operator has to get right."""

import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, class string, score int, rate string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and names that clash."""
    long_text = " ".join(f"word{i % 5000} Über" for i in range(60_000))
    rows = [
        (1, "The same text twice", "en", "a", 19, "x", 1, "r", "q"),
        (2, "the SAME text twice", None, "b", 19, None, None, None, None),
        (2, "the SAME text twice", None, "b", 19, None, None, None, None),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "en", "", 0, "", 0, "", ""),
        (5, " \t\n ", "de", "a", 4, "x", 1, "r", "q"),
        (6, "one", "de", "b", 3, "x", 1, "r", "q"),
        (7, long_text, "en", "a", len(long_text), "x", 1, "r", "q"),
        (8, "\x00 zero \x00\x00 and \U0001f600 ́ mark", None, "c", 5, "x", 1, "r", "q"),
        (9, "x" * 200_000, "fr", "c", 200_000, "x", 1, "r", "q"),
        (10, "<|endoftext|> 12,345 %%% !!!", "fr", None, 5, "x", 1, "r", "q"),
        (None, "no name at all", "en", "a", 14, "x", 1, "r", "q"),
        (None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def table(spark, name, folder=SF):
    return spark.read.parquet(f"{folder}/{name}.parquet")
