"""Texts shared by the tests of the corpus operators."""

#: Texts that every operator must take: null, empty, blank, marks only, ties, repeats, beyond ASCII.
ODD_TEXTS = [
    None, "", " \n\t ", "!!! ???", "one", "one", "Ünïcödé 日本語 \U0001f600", "a\x00b",
    "word " * 30_000, "line\n" * 50, "the same words here " * 3,
]
