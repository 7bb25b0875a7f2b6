"""Small tables with the awkward cases: NULLs, empty and long texts, ties, repeats, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, kept string, n int, slot long, "
          "size long, shard string, node long, h string, hub string, score string, bytes string")


def rows(texts, sources=("a", "b", None)):
    return [(i, t, "en", sources[k % len(sources)], 7, 1, "x", 2, 3, 4, "s", 5, "h", "u", "y", "z") for k, (i, t) in enumerate(texts)]


def edge_texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    base = [word() for _ in range(120)]
    texts = [(1, None), (2, ""), (3, "one"), (4, "one"), (None, "one"), (5, "two words"), (5, "two words"), (6, "  \n"),
             (7, "x" * 50_000), (8, " ".join(word() for _ in range(6000)))]
    for i in range(10, 40):  # edited copies of one text
        copy = list(base)
        for _ in range(rnd.randint(0, 5)):
            copy[rnd.randrange(len(copy))] = word()
        texts.append((i, " ".join(copy)))
    texts += [(i, " ".join(base)) for i in range(40, 60)]
    texts += [(i, " ".join(word() for _ in range(rnd.randint(1, 80)))) for i in range(60, 120)]
    return texts


def edge_docs(spark):
    return spark.createDataFrame(rows(edge_texts()), SCHEMA).repartition(5)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
