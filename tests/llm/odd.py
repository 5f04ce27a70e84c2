"""Rows that operators must take as they are."""

# nulls, empty, blank, repeated and long texts, marks, wide white space, and columns named like internal ones
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog " * 3, "a", 7, "s"),
    (2, "The quick brown fox jumps over the lazy dog " * 3, "a", 8, "s"),
    (3, None, "b", None, None),
    (4, "", "b", 1, "x"),
    (5, " \t\n", None, 1, "x"),
    (6, "one", None, 1, "x"),
    (6, "one", None, 1, "x"),
    (None, "nameless text with a few words", "c", 1, "x"),
    (None, "nameless text with a few words", "", 1, "x"),
    (8, "word " * 9000 + "x" * 9000, "c", 1, "x"),
    (9, "has <P> a mark and SHOUTS & more", "c", 1, "x"),
    (10, "日本語　の テスト\n\n émile\xa0 <|endoftext|> \U0001f600 it's", "d", 1, "x"),
    (11, "one", "d", 1, "x"),
]
ODD_SCHEMA = "doc_id bigint, text string, source string, prefix int, mask string"
