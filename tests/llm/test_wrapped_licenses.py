"""Licence notices wrapped over lines."""

from __future__ import annotations

import textwrap

import pytest

from terracelake.llm.licenses import TEMPLATES, scan_licenses

BSD = """Copyright (c) 2020, Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:
"""
MPL = """ * This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
GPL = """# This program is free software: you can redistribute it and/or
# modify it under the terms of the GNU General Public License as
# published by the Free Software Foundation, either version 3
"""


@pytest.mark.parametrize("before", [0, 63, 64, 500])
def test_wrapped_notices(spark, before):
    texts = ["\n".join(["other"] * before) + "\n" + t + "other words\n" * 90 for t in (BSD, MPL, GPL)]
    spread = "\n".join(w + " filler" * 9 for w in next(t for label, t in TEMPLATES if label == "bsd").split())
    docs = spark.createDataFrame([*enumerate(texts), (3, spread), (4, None), (5, "\n\n")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(docs).collect()}
    assert got == {0: ("bsd", 1.0), 1: ("mpl", 1.0), 2: ("gpl", 1.0), 3: ("", 0.0), 4: ("", 0.0), 5: ("", 0.0)}


def test_every_clause_gives_its_own_label_however_wrapped(spark):
    """Beside it there is only what the base phrases say, as "general public license" does in every GNU notice."""
    rows = [(i, "x y z\n" * 40 + textwrap.fill(notice, 24) + "\nx y z" * 40) for i, (_, notice) in enumerate(TEMPLATES)]
    rows += [(1000 + i, notice) for i, (_, notice) in enumerate(TEMPLATES)]
    got = {r.doc_id: (set(r.labels.split(",")), set(filter(None, r.base_labels.split(","))), r.score)
           for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(TEMPLATES):
        for at in (i, 1000 + i):
            labels, base, score = got[at]
            assert labels == {label} | base and score == 1.0, TEMPLATES[i]


def test_what_is_no_notice(spark):
    texts = ["Licensed under the terms of the license", "the library is licensed under the license of this work", "a copy of the license",
             "GNU Lesser General Public", "Licensed under CC BY-ND 4.0", "cc by 4 0", "permission is granted to any person of this notice",
             "this software is provided as is and without any warranty"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.labels, r.score) for r in scan_licenses(docs).collect()} == {(i, "", 0.0) for i in range(len(texts))}
