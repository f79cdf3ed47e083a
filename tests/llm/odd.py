"""Documents with one row or more per odd case, and brute-force helpers."""

import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "kept string, rules string, language string, tokens long, labels string, row string, "
          "`set` string, bin string, start string, shard string, visible_text string")
PROSE = ("The quick brown fox jumps over the lazy dog near the river bank, while seven old men "
         "sit under the tall oak trees and talk about the weather of last summer.")
LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(20_000))
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    texts = [
        (1, PROSE, "en"), (2, PROSE, "en"), (3, PROSE + " Indeed.", "en"),
        (4, None, "en"), (5, "", None), (6, " \n\t ", "fr"), (7, "word", "en"),
        (8, "Été à la plage. " * 3, "fr"), (9, LONG, "en"), (10, "!!! ??? ...", None),
        (None, PROSE, None), (None, None, None), (11, PROSE, "en"), (11, PROSE, "en"),
        (11, PROSE, "en"), (12, "a | b | c | d\n" + PROSE, "en"), (13, "\x00odd\x7f bytes 😀 İ", "de"),
        (14, "x" * 100_000, "en"), (15, "eins zwei drei vier fünf sechs sieben acht", "de"),
    ]
    return [(i, t, lang, None if i == 3 else f"src{(i or 0) % 2}", None, 0.5, "k", "r", "l", 1,
             "x", "y", "z", "b", "s", "h", "v") for i, t, lang in texts]


def documents(spark, some=None):
    return spark.createDataFrame(some if some is not None else rows(), SCHEMA)


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def words(text):
    return SPACE_WORD.findall(text or "")
