"""Every name of the list gives spans, and passphrases may have spaces."""

import pytest

from lodegrain.llm import secret_scan

VALUE = "Zx9qT7LmK2vBn4Wd"


@pytest.mark.parametrize("part", sorted(secret_scan.SENSITIVE))
def test_every_listed_name_reaches_the_threshold(part):
    for name in (part, f"my_{part}"):
        text = f'{name} = "{VALUE}"'
        assert VALUE not in secret_scan.redact_text(text)
        assert [text[a:b] for a, b in secret_scan.assigned_literals(text)] == [VALUE]


def test_phrases_and_plain_words():
    found = lambda t: [t[a:b] for a, b in secret_scan.assigned_literals(t)]
    phrase = "correct horse battery staple"
    for name in ("passphrase", "password", "db_pwd", "passPhrase"):
        assert found(f'{name} = "{phrase}"') == [phrase]
    assert found(f'p = "{phrase}"\npassphrase = p') == [phrase]
    assert found(f'token = "{phrase}"') == [] and found('key = "a plain label 12"\nauth: basic_scheme\nsalt = "seasalted"') == []
