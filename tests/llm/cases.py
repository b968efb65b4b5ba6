"""Inputs and helpers shared by the tests of this folder."""


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


EDGE = [
    (1, "one two three four five"), (2, None), (3, ""), (4, "  \t\n "), (5, "one two three four five"),
    (5, "one two three four five"), (None, "one two three four five"), (6, "x"), (7, "word " * 60_000), (8, "ümläut çédille 語 中文"),
    (9, "a" * 300_000),
]
