from __future__ import annotations

from quire.llm import license_scan
from tests.llm.helpers import frame

BSD2 = """/* Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 *
 * 1. Redistributions of source code must retain the above copyright notice, this
 *    list of conditions and the following disclaimer.
 *
 * 2. Redistributions in binary form must reproduce the above copyright notice,
 *    this list of conditions and the following disclaimer in the documentation
 *    and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """ *
 * 3. Neither the name of the copyright holder nor the names of its
 *    contributors may be used to endorse or promote products derived from
 *    this software without specific prior written permission.
"""
LGPL = """# This library is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version.
#
# This library is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
# Lesser General Public License for more details.
"""
AGPL = """-- This program is free software: you can redistribute it and/or modify
-- it under the terms of the GNU Affero General Public License as published by
-- the Free Software Foundation, either version 3 of the License, or
-- (at your option) any later version.
--
-- This program is distributed in the hope that it will be useful,
-- but WITHOUT ANY WARRANTY; without even the implied warranty of
-- MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
-- GNU Affero General Public License for more details.
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""
CASES = ((BSD2, "BSD-2-Clause/text"), (BSD3, "BSD-3-Clause/text"), (LGPL, "LGPL-2.1/notice"), (AGPL, "AGPL-3.0/notice"), (EPL, "EPL-2.0/made"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause/spdx"), ("All rights reserved.", ""))


def test_rules_of_real_headers(spark):
    rows = [(i, t, "", "", 0) for i, (t, _) in enumerate(CASES)]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert [got[i].rules for i in range(len(CASES))] == [r for _, r in CASES]
    assert got[1].licenses == "BSD-3-Clause" and got[1].n_licenses == 1


def test_every_sentence_is_in_a_rule():
    used = {i for _, _, ids in license_scan.RULES for i in ids}
    apart = set(license_scan.SENTENCES) - used
    assert apart <= {"gpl_copy", "mit_asis", "isc_asis", "mpl_copy", "mpl_copy_https"}  # these follow a licence's own words
