"""Plain word rules the tests compare with."""

import re


def words_of_spaces(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def words_of_letters(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
