"""Bare random tokens of small alphabets and of 16 characters and more."""

import random
import string

import pytest

from ratify.llm.secret_scan import Scan, Scanner


@pytest.mark.parametrize("alphabet, least", [("0123456789abcdef", 0.96), (string.ascii_lowercase + string.digits, 0.95),
                                             (string.ascii_uppercase + "234567", 0.9),
                                             (string.ascii_letters + string.digits, 0.88)])
@pytest.mark.parametrize("size", [16, 20, 23, 24, 32])
def test_random_tokens_are_found_whole(alphabet, least, size):
    rng, scanner, found = random.Random(size), Scanner(Scan()), 0
    for _ in range(400):
        text = "see " + "".join(rng.choice(alphabet) for _ in range(size)) + " here"
        base = scanner.base(text)
        found += any(a <= 4 and b >= 4 + size for a, _, b in base + scanner.added(text, base))
    assert found >= least * 400


def test_words_and_numbers_are_not_tokens():
    scanner = Scanner(Scan())
    for text in ("internationalization 2024", "configuration2024", "0123456789012345678", "section-12/paragraph-3/sentence-4",
                 "INTERNATIONALIZATION", "550e8400-e29b-41d4-a716-446655440000", "aaaaaaaaaaaaaaaaaaa1aaaaaaaa1a"):
        assert scanner.added(text, scanner.base(text)) == []
