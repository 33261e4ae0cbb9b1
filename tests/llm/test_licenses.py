import math
import os
import random
from collections import Counter

import numpy as np
import pytest

from quillmill.llm import licenses

COMMON = "/usr/share/common-licenses"
EVEN = {t: 1.0 for t in licenses.vocabulary(licenses.TEMPLATES)}
GPL3 = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and t.startswith("This program"))


def test_own_and_inherited_licences(spark):
    mit = licenses.TEMPLATES[3][1]
    rows = [
        ("repo/LICENSE", mit), ("repo/src/a.py", "print(1)"), ("repo/src/deep/b.py", "x"), ("repo/vendor/COPYING", GPL3), ("repo/vendor/lib/c.c", "int x;"),
        ("repo/vendor/own.c", "// Licensed under the Apache License, Version 2.0.\nint y;"), ("other/d.txt", "my licence to drive"), ("repo/vendor/COPYING", GPL3),
        (None, None), ("", ""), ("top.txt", "long " * 50000),
    ]
    out = licenses.scan_licenses(spark.createDataFrame([(*r, "old") for r in rows], "path string, text string, license string")).collect()
    got = {r.path: (r.license, r.inherited_from) for r in out}
    assert len(out) == len(rows) and "text" not in out[0].asDict()
    assert got["repo/LICENSE"] == ("MIT", None) and got["repo/src/a.py"] == ("MIT", "repo") and got["repo/src/deep/b.py"] == ("MIT", "repo")
    assert got["repo/vendor/lib/c.c"] == ("GPL-3.0", "repo/vendor") and got["repo/vendor/own.c"] == ("Apache-2.0", None)
    assert got["other/d.txt"] == (None, None) and got[None] == (None, None) and got["top.txt"] == (None, None)
    assert licenses.scan_licenses(spark.createDataFrame([], "path string, text string")).count() == 0


@pytest.mark.parametrize(("name", "text"), licenses.TEMPLATES)
def test_templates_match_themselves(name, text):
    m = licenses.Matcher(EVEN)
    assert m.scan(f"Some words.\n{text}\nOthers.")[0] == name
    assert m.scan("Nothing of this kind; a driving licence is a document.")[0] is None


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("MPL-2.0", "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy"),
        ("Unlicense", "This is free and unencumbered software released into the\npublic domain."),
        ("Unlicense", "This is free and unencumbered software released into the public\ndomain."),
        ("GPL-2.0", " * This program is free software; you can redistribute it\n * and/or modify it under the terms of the GNU General\n * Public License as published by the Free Software\n * Foundation; either version 2 of the License, or (at\n * your option) any later version."),
        (None, "all rights were reserved for him"), (None, "Version 2.0"), (None, "my licence to drive"),
    ],
)
def test_wrapped_headers(name, text):
    assert licenses.Matcher(EVEN).scan(f"int main;\n{text}\nsome other words follow here")[0] == name


def brute_windows(m, words, template):
    """(cosine, start) of all windows that reach the template's least cosine."""
    inverse = {i: w for w, i in m.number.items()}
    weight = [math.sqrt(x) for x in m.square]
    t = m.adds[template] / m.square
    n = min(m.sizes[template], len(words))
    out = []
    for start in range(len(words) - n + 1):
        count = Counter(words[start : start + n])
        other = sum(c for w, c in count.items() if w not in m.number)
        size = math.sqrt(sum((c * weight[m.number[w]]) ** 2 for w, c in count.items() if w in m.number) + other * m.rare)
        cosine = sum(c * m.square[i] * t[i] for i, w in inverse.items() if (c := count.get(w))) / size
        if cosine >= m.least[template]:
            out.append((round(cosine, 9), start))
    return out


def test_windows_equal_brute_force():
    rng = random.Random(3)
    words = sorted(EVEN)
    m = licenses.Matcher({t: rng.uniform(0.5, 9) for t in words})
    met = 0
    for _ in range(40):
        text = [w if rng.random() < 0.9 else f"other{rng.randrange(9)}x" for w in licenses.terms(rng.choice(licenses.TEMPLATES)[1])]
        text = [*rng.choices(words, k=rng.randrange(9)), *text, *rng.choices(["foo", "bar", "the"], k=9)]
        at = np.array([m.number.get(w, len(m.number)) for w in text])
        for t in range(len(m.names)):
            want = brute_windows(m, text, t)
            got = m.windows(at, t)
            met += len(got)
            # All that are left out overlap one that is as good.
            assert {(round(c, 9), s) for c, s, _ in got} <= set(want)
            n = min(m.sizes[t], len(text))
            assert all(any(abs(s - s2) < n and c2 >= c - 1e-9 for c2, s2, _ in got) for c, s in want)
            here = set(text)
            if want:
                assert sum(m.most[t][i] for w, i in m.number.items() if w in here) >= m.least[t] ** 2 - 1e-6
    assert met > 100


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts here")
def test_whole_texts_of_common_licences():
    """By the built-in titles and headers, and by whole texts as templates."""
    names = {"GFDL": "GFDL-1.3", "GPL": "GPL-3.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL": "LGPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-3": "LGPL-3.0"}
    texts = {n: t for n, t in licenses.read_templates(COMMON) if not os.path.islink(f"{COMMON}/{n}")}
    df = Counter(w for _, t in licenses.TEMPLATES for w in set(licenses.terms(t)))
    m = licenses.Matcher({w: math.log(1 + len(licenses.TEMPLATES) / n) for w, n in df.items()})
    assert {n: m.scan(t)[0] for n, t in texts.items()} == {n: names.get(n, n) for n in texts}
    whole = list(texts.items())
    m = licenses.Matcher({t: 1.0 for t in licenses.vocabulary(whole)}, whole)
    for n, t in texts.items():
        name, cosine, share = m.scan("Our copy\n" + t.replace("\n", " * "))
        assert name == n and cosine > 0.99 and share > 0.9
