"""Rows with every awkward case."""

#: Rows with every awkward case: nulls, empty and blank texts, repeats, ties, a long text.
LONG = " ".join(f"word{i} filler{i % 7} tail{i % 11}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
TEXTS = [
    (1, "a plain text of its own with quite enough words to be judged by the rules", "b", 1),
    (2, f"start one {PASSAGE} end one", "a", 2),
    (3, f"begin two {PASSAGE} and more", "a", 3),
    (4, None, "a", 4),
    (5, "", None, 5),
    (6, " \t\n\r ", "b", 6),
    (7, "é", "c", 7),
    (8, LONG, "c", 8),
    (9, LONG, "a", 9),
    (9, LONG, "a", 9),
    (10, "same same same same same same same same same same same same", "b", None),
    (None, "a plain text of its own with quite enough words to be judged by the rules", "b", 11),
    (None, None, None, None),
    (12, "Привет, мир! " * 30 + "línea\nlínea\nlínea", "c", 12),
    (-3, f"minus {PASSAGE}", "d", 13),
]
