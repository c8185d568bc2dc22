"""Documents with the values that operators must stand: nulls, blanks, very long texts, ties and repeated rows."""

COMMON = "A line that many documents hold."
BENCH = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"

TEXTS = [
    (0, f"{COMMON}\nfirst text about nothing much at all\n  a LINE that many documents hold.\t\nend"),
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r\n "), (None, "a row without an id says a few words"),
    (5, "same text twice in the table"), (5, "same text twice in the table"), (6, "same text twice in the table"),
    (7, f"before {BENCH.upper()} after"), (8, "x " + "alpha beta gamma delta epsilon zeta eta theta iota" + " y"),
    (9, "word " * 30_000), (10, "z" * 120_000), (11, "ein kleiner Text über nichts, und der ist nicht lang"),
    (12, "one two three"), (13, "one two"), (14, "one"), (15, "###|||***"), (16, "\n\n\n"), (17, "tiny item"),
    (18, "no\x1cbreak\x85here\xa0nor there"), (19, "á b́ naïve 漢字 текст"),
] + [(100 + i, f"{COMMON}\nown line number {i} of this text") for i in range(12)]


def frame(spark, texts=TEXTS):
    """The cases with the other columns of ``documents`` and columns that clash with those of operators."""
    rows = [(i, t, "en" if i != 11 else "de", f"src{(i or 0) % 3}", None, "kept?", 1.5, 3) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, n_lines int"
    return spark.createDataFrame(rows, schema).repartition(4)


def empty(spark):
    return frame(spark).limit(0)
