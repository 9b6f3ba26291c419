"""Documents with the odd cases that every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like the operators' own.
CLASHING = (
    "size score node row _row _id ids k1 k2 id slice bands _spans copies a b label target source_size _size sig"
).split()
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def odd_rows():
    return [
        (1, "one two three four five six seven eight", "en", "s1", 39),
        (1, "one two three four five six seven eight", "en", "s1", 39),
        (2, None, None, None, None),
        (3, "", "en", "s1", 0),
        (4, "", None, "s2", 0),
        (None, "a text without an id", "en", None, 20),
        (None, None, None, None, None),
        (5, " \n\t ", "en", "s2", 4),
        (6, LONG, "en", "s1", len(LONG)),
        (7, "naïve 日本語 \U0001f600 don't <|endoftext|> x", "fr", "s3", None),
        (-8, "ties", "en", "s3", 4),
        (9, "ties", "en", "s4", 4),
    ]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def clashing_documents(spark):
    from pyspark.sql import functions as F

    return odd_documents(spark).withColumns({c: F.lit("x") for c in CLASHING})


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
