"""The awkward documents of the tests."""

BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
TEXTS = [
    (1, BASE, "en"), (2, BASE, "en"), (3, BASE.upper() + " phi", "en"), (4, None, None), (5, "", "en"), (6, " \n\t ", "de"),
    (7, "one two", "en"), (8, "two one", "en"), (9, "one  two", "fr"), (10, "Licensed under the Apache License, Version 2.0.", "en"),
    (11, "MIT license. mit LICENSE\nGNU General Public License", "en"), (12, "1234 !!! 5678", "en"),
    (13, "word " * 20000, "en"), (14, "first line.\nsecond line.\nthird", "en"), (14, "first line.\nsecond line.\nthird", "en"),
    (None, BASE, "en"), (15, "don't <|endoftext|> stop 漢字 é\x85", "en"), (-50, "x " * 10 + "ünï", "de")]
