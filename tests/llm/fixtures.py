"""Rows that every operator has to bear."""

import random

DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use for columns of their own
    "fp long, length long, kept boolean, key string, offset long, _id long, _text long, _cuts int, _found int, spans string, ids string"
)
CLASH = (1, 2, True, "k", 3, 4, 5, 6, 7, "s", "i")


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASH)


def documents(spark, *rows):
    return spark.createDataFrame([document(*row) for row in rows], DOCUMENTS)


def plain(spark, *rows):
    """Documents with the columns of the table and no others."""
    return documents(spark, *rows).select("doc_id", "text", "lang", "source", "n_chars")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def odd_rows():
    """Nulls in every place, empty, blank, repeated, tied and very long."""
    rng = random.Random(5)
    long_text = "\n".join(words(rng, 40) for _ in range(800))
    same = words(rng, 80)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\n "),
        (4, same),
        (5, same),
        (6, long_text),
        (6, long_text),
        (None, same + " end"),
        (None, None),
        (7, "one"),
        (8, "Ünï çödé   word s \U0001f600 " + words(rng, 60)),
    ]
