"""Wrapped headers, licence files, SPDX tags and statements inside long lines."""

import textwrap

import pytest

from lodegrain.llm import license_scan

KNOWN = license_scan.Templates(license_scan.TEMPLATES)
BSD_2 = """Copyright (c) 2020, Some Body

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = f"""{BSD_2}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""


def license_of(text):
    good, score, _ = KNOWN.matches(text, 0.6)
    return min(good)[1] if good else None


def wrapped(text, mark="", width=60):
    return "\n".join(mark + line for part in text.split("\n") for line in textwrap.wrap(part, width) or [""])


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl ", "REM "])
def test_wrapped_forms_name_themselves(mark):
    for name, forms in license_scan.TEMPLATES.items():
        for form in forms:
            assert license_of(f"code = 1\n{wrapped(form, mark, 34)}\n\nmore = 2") == name, form


def test_licence_files():
    assert license_of(wrapped(BSD_2)) == "BSD-2-Clause" and license_of(wrapped(BSD_3)) == "BSD-3-Clause"


def test_spdx_tags():
    for tag, name in (("MIT", "MIT"), ("GPL-2.0-only", "GPL-2.0"), ("LGPL-3.0-or-later", "LGPL-3.0"), ("GPL-3.0+ */", "GPL-3.0"), ("(MIT OR Apache-2.0)", "Apache-2.0"), ("bsd-3-clause", "BSD-3-Clause")):
        assert license_of(f"// SPDX-License-Identifier: {tag}\nint x;") == name
    assert license_of("# SPDX-License-Identifier: Unheard-Of-1.0") is None


def test_statements_inside_long_lines():
    plain = "all the pages of this small site are Released under the MIT License."
    assert license_of(plain) == "MIT"
    for before, after in ((0, 300), (17, 300), (300, 0), (33, 33)):
        assert license_of(f"{'word ' * before}{plain}{' word' * after}") == "MIT"
    assert license_of("The driver lost his license and the permission to drive.") is None
