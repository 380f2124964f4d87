"""Documents with nulls, empty and very long texts, repeated rows and column names that operators use inside."""

CLASHING = (
    "size n score y row kept sig rep family component block part turn bucket target digest dropped line_doc_id "
    "batch h1 h2 f1 f2 held_out predicted m item_id source_size taken epochs goal s vals asks member blocks k low high"
).split()

LONG = " ".join(f"word{k % 977} filler{k % 31}" for k in range(40_000))

ROWS = [
    (1, "A plain line of text that is long enough.\nsecond line here", "en", "a", 10),
    (2, None, "en", "a", None),
    (3, "", "en", None, 0),
    (4, " \t\n\x0b\x0c\r ", None, "b", 7),
    (5, LONG, "en", "b", len(LONG)),
    (6, "A plain line of text that is long enough.\nsecond line here", "en", "a", 10),
    (6, "A plain line of text that is long enough.\nsecond line here", "en", "a", 10),
    (None, "text without an id, but with words", "de", "c", 5),
    (None, None, None, None, None),
    (9, "one", "en", "c", 3),
    (10, "Ünïcödé \U0001f600 текст 中文 <|endoftext|> tail", "xx", "c", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        df = df.selectExpr("*", *[f"'{name}' as {name}" for name in CLASHING])
    return df


def empty(spark):
    return documents(spark, [])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
