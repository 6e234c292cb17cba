"""Small document tables with every awkward row, and brute-force graph search."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size2 string"

LONG = "lorem ipsum dolor sit amet " * 20_000


def documents(spark, rows=None):
    """Nulls in every column, empty and very long texts, ties and repeated rows, an extra column."""
    if rows is None:
        rows = [
            (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 10, "x"),
            (2, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 10, "x"),
            (2, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 10, "x"),
            (3, None, "en", "b", None, None),
            (4, "", "de", None, 0, "y"),
            (5, " \t\n\x0b\f\r ", None, "b", 7, "y"),
            (None, "der die das und ist ein Wort\nmit Zeile", "de", "b", 3, "z"),
            (6, LONG, "la", "c", len(LONG), "z"),
            (7, "12 34 56", "en", "c", 8, None),
            (7, "Ünïcödé naïve\u00a0café \U0001f600 <|endoftext|> don't  stop\n\nnow", None, None, 1, None),
        ]
    return spark.createDataFrame(rows, DOCS)


def components(n, pairs):
    """Smallest index reachable from each index."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]
