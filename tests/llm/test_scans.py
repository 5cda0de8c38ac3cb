"""Personal data, secrets and license notices against plain searches of the whole text."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.llm import license_scan, pii, secret_scan, spans

PIECES = ["1", "22", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "255", "4111111111111111", "token", "=", '"', "ſecret", "SECRET", ":"]
PIECES += ["AKIA", "ABCDEF0123456789", "0af", "Passwd", "'", "api_key", "apikey", "99999", "0123456789abcdef", "é", "\n", "İ", "😀"]
texts = st.lists(st.sampled_from(PIECES), max_size=18).map("".join)


def plain_pii(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m[0] if c.isdigit()]
        folded = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(folded) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def plain_secrets(t):
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    out = [(m.start(), m.end(), "assign") for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]


@settings(max_examples=400, deadline=None)
@given(texts)
def test_base_spans_equal_plain_searches(text):
    assert sorted(pii.base_spans(text)) == sorted(plain_pii(text))
    assert sorted(secret_scan.scanner()(text)[0]) == sorted(plain_secrets(text))


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "+1 " * 50_000, "1." * 50_000, "x1" * 100_000, "1 " * 60_000):
        assert sorted(pii.base_spans(text)) is not None
        pii.signed_runs(text)


def expected(doc_id, text, plain, kinds):
    base = spans.ordered(plain(text or ""), kinds)
    listed = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
    return hashlib.sha256(listed.encode()).hexdigest(), base


def check(docs_of, rows, operator, plain, module):
    out = {r.doc_id: r for r in spans.digest(operator(docs_of(rows)), module.BASE).collect()}
    assert len(out) == len(rows)
    for doc_id, text in rows:
        sha, base = expected(doc_id, text, plain, module.KINDS)
        row = out[doc_id]
        assert row.base_sha256 == sha
        assert [row[f"n_{k}"] for k in module.BASE] == [sum(b[2] == k for b in base) for k in module.BASE]
        assert {f"{k}:{s}:{e}" for s, e, k in base} <= set(row.spans.split(","))
    return out


def odd_rows(small_texts):
    random.seed(1)
    rows = list(small_texts.values()) + ["".join(random.choice(PIECES) for _ in range(20)) for _ in range(200)]
    return list(enumerate([*rows, None, "", "same 10.1.2.3", "same 10.1.2.3", "é 10.0.0.1 " * 3000]))


def test_personal_data_query(docs_of, small_texts):
    check(docs_of, odd_rows(small_texts), pii.personal_data, plain_pii, pii)
    assert pii.personal_data(docs_of([])).collect() == []


def test_secrets_query(docs_of, small_texts):
    check(docs_of, odd_rows(small_texts), secret_scan.secrets, plain_secrets, secret_scan)


def test_checksums_decide_tokens():
    body = "abcdefghijABCDEFGHIJ0123456789"
    good = f"x ghp_{body}{secret_scan.checksum(body)} y npm_{body}{secret_scan.checksum(body)}"
    bad = f"x ghp_{body}000000 y"
    assert [s[2] for s in secret_scan.scanner()(good)[1]] == ["github", "npm"]
    assert secret_scan.scanner()(bad)[1] == []


def test_field_decodes_as_every_path_compared():
    field = pii.train(steps=40)
    sequences = [w for w, _ in pii.labelled_sequences()]
    emissions = [field.emissions(w) for w in sequences]
    import itertools

    for e, got in zip(emissions, field.viterbi(emissions)):
        if len(e) > 4:
            continue
        paths = itertools.product(range(len(pii.LABELS)), repeat=len(e))
        worth = lambda p: field.begin[p[0]] + sum(e[t][x] for t, x in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:])) + field.end[p[-1]]
        assert np.isclose(worth(tuple(got)), max(map(worth, paths)))


def test_field_finds_what_the_patterns_miss():
    scan = pii.scanner(pii.train())
    found = lambda t: [(t[s:e], k) for s, e, k in scan(t)[1]]
    assert found("please call (212) 555-0143 tonight") == [("(212) 555-0143", "crf_phone")]
    assert found("in 1987 it sold 350 units") == []
    assert found("write to a.b@example.org now") == []  # a base span already


def test_field_finds_spelled_out_addresses(docs_of):
    scan = pii.scanner(pii.train())
    found = lambda t: [(t[s:e], k) for s, e, k in scan(t)[1]]
    for address in ("anna.lee(at)example.org", "anna.lee[at]example.org", "bob (at) example.com", "anna at example dot org", "j.r.lee at mail dot example dot com"):
        assert found(f"you can write to {address} about it") == [(address, "crf_email")], address
        row = spans.digest(pii.personal_data(docs_of([f"to {address}\nnow"])), pii.BASE).collect()[0] if "(at)" in address else None
        assert row is None or row.spans.startswith("crf_email:3:")
    assert found("we looked at the dot on a map") == found("they sat at the table") == []


def test_field_parts_words_at_blanks_of_every_kind():
    scan = pii.scanner(pii.train())
    for text in ("tel 555-0198 12 units (212) 555-0143 now", "dial 001 212 555 0188 tonight", "ask anna at example dot org first"):
        want = scan(text)[1]
        for blank in ("\n", "\u00a0", "\u2003", "\t"):
            assert scan(text.replace(" ", blank))[1] == want


def test_license_notices(docs_of):
    rows = ["Some prose.\nReleased under the MIT License.\nMore prose of it.", "licensed under the apache license version 2.0"]
    rows += ["A license to print money.", None, "", "Licensed under CC BY-NC 4.0. " + "word " * 200 + "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 2."]
    out = license_scan.licenses(docs_of(rows)).collect()
    got = sorted((r.doc_id, r.license, rows[r.doc_id][r.start : r.end]) for r in out)
    assert got == [
        (0, "MIT", "Released under the MIT License"),
        (1, "Apache-2.0", "licensed under the apache license version 2.0"),
        (5, "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
        (5, "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
        (6, "GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ]
    assert all(r.reduction > 0 for r in out) and {r.differences for r in out} == {""}
    assert license_scan.licenses(docs_of([])).collect() == []
    near = license_scan.licenses(docs_of(["Released under the famous MIT License"])).collect()
    assert [(r.license, r.differences) for r in near] == [("MIT", "delete 'famous' / ''")]


def kinds(text):
    return [(r["license"], text[r["start"] : r["end"]]) for r in license_scan.scanner()(text)]


def test_license_version_and_name_decide():
    r = random.Random(3)
    prose = "the a of work under license public general version 2 and code is this".split()
    for version in "23":
        notice = f"This work is licensed under the GNU General Public License, version {version}"
        for n in range(60):
            before, after = (" ".join(r.choice(prose + [f"w{n}", "copyright"]) for _ in range(r.randint(0, 50))) for _ in range(2))
            assert (f"GPL-{version}.0", notice) in kinds(f"{before}. {notice}. {after}"), (before, after)
    assert kinds("This work is licensed under the GNU Affero General Public License, version 3.")[0][0] == "AGPL-3.0"
    assert [k for k, _ in kinds("This work is licensed under a Creative Commons Attribution 4.0 International License")] == ["CC-BY-4.0"]
    assert kinds("This work is licensed under the GNU General Public License, version 7") == []


def test_license_short_forms_and_tags(docs_of):
    rows = ["Licensed under CC BY-SA 4.0", "see CC BY 4.0 there", "photo: CC-BY-NC-4.0.", "// SPDX-License-Identifier: Apache-2.0", "# SPDX-License-Identifier: GPL-2.0-or-later", "cc by all, success"]
    out = license_scan.licenses(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.license) for r in out) == [(0, "CC-BY-SA-4.0"), (1, "CC-BY-4.0"), (2, "CC-BY-NC-4.0"), (3, "Apache-2.0"), (4, "GPL-2.0")]


def test_all_notices_of_a_block_are_found():
    exact, changed = "Released under the MIT License", "Released under the famous MIT License"
    assert [w for _, w in kinds(f"{changed}. Some words. {exact}.")] == [changed, exact]
    assert [w for _, w in kinds(f"{exact}. {changed}. {exact}")] == [exact, changed, exact]
    # the longest run of common words fails here, the notice after or before it does not
    assert [w for _, w in kinds(f"Released under the MIT banner. {changed}.")] == [changed]
    assert [w for _, w in kinds(f"{changed}. Released under the MIT banner of it")] == [changed]


def test_long_sequences_are_decoded_in_bounded_batches():
    """Batches by padded words; pieces and batches change no result."""
    import random
    import tracemalloc

    from tallyflow.llm import pii

    r = random.Random(1)
    numbers = lambda n: " ".join(str(r.randint(1, 99_999)) for _ in range(n))
    long = numbers(20_000) + " x " + " y ".join(numbers(3) for _ in range(255))
    find = pii.scanner(pii.train())
    find(numbers(100))
    tracemalloc.start()
    whole = find(long)
    assert tracemalloc.get_traced_memory()[1] < 60_000_000
    tracemalloc.stop()
    cells, piece = pii.CELLS, pii.PIECE
    pii.CELLS, pii.PIECE = 50, 7
    try:
        assert pii.scanner(pii.train())(long) == whole
    finally:
        pii.CELLS, pii.PIECE = cells, piece
    sizes = sorted(r.randint(1, 90_000) for _ in range(300))
    groups = list(pii.grouped(list(range(300)), sizes))
    assert sum(groups, []) == list(range(300))
    assert all(len(g) == 1 or len(g) * sizes[g[-1]] <= pii.CELLS for g in groups)


def test_full_texts_headers_and_expressions():
    """What one-sentence templates used to miss."""
    mit = [t for n, t in license_scan.TEMPLATES if n == "MIT"][2:]
    whole = "Copyright (c) 2020 Someone. " + ". ".join(mit) + ". THE SOFTWARE IS PROVIDED AS IS."
    assert [w for _, w in kinds(whole)] == mit and {k for k, _ in kinds(whole)} == {"MIT"}
    texts = {
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": ["GPL-2.0"],
        "This library is free software: you can redistribute it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": ["LGPL-3.0"],
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": ["ISC"],
        "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this work.": ["CC0-1.0"],
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License": ["CC-BY-3.0"],
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available there": ["EPL-2.0"],
        "This is free and unencumbered software released into the public domain.": ["Unlicense"],
        "SPDX-License-Identifier: ISC": ["ISC"],
        "// SPDX-License-Identifier: MIT OR Apache-2.0": ["MIT", "Apache-2.0"],
        "SPDX-License-Identifier: GPL-2.0-only AND BSD-3-Clause": ["GPL-2.0", "BSD"],
    }
    assert {t: [k for k, _ in kinds(t)] for t in texts} == texts


def test_licenses_come_from_the_compressed_sizes(monkeypatch):
    """With a compressor that tells templates nothing about the block, nothing is found."""
    notice = "Some words. This work is licensed under the GNU General Public License, version 2. More words."
    assert len(kinds(notice)) == 1
    saved = license_scan.Templates.size
    monkeypatch.setattr(license_scan.Templates, "size", lambda self, text, compressor=None: saved(self, text) - (compressor is not None))
    assert kinds(notice) == []


def test_every_stretch_of_a_block_against_all_templates():
    """Brute force: any stretch whose words are a template's, exactly, is found or overlaps
    one that is; what is found without differences is a template word for word."""
    r = random.Random(8)
    lists = [(n, [w.lower() for w in license_scan._WORD.findall(t)]) for n, t in license_scan.TEMPLATES]
    filler = "the code of a public work is free for all and any later version copyright license".split()
    for _ in range(60):
        chosen = r.sample(lists, r.randint(1, 3))
        words = [w for n, t in chosen for w in [*(r.choice(filler) for _ in range(r.randint(3, 30))), *t]] + ["end"]
        text = " ".join(words)
        got = [(x["license"], len(text[: x["start"]].split()), len(text[: x["end"]].split()), x["differences"]) for x in license_scan.scanner()(text)]
        for name, template in lists:
            for at in range(len(words) - len(template) + 1):
                if words[at : at + len(template)] == template:
                    assert any(s < at + len(template) and at < e for _, s, e, _ in got), (name, template, got)
        for name, start, end, differences in got:
            if not differences:
                assert (name, words[start:end]) in lists or words[start - 1] in license_scan.JOINTS
