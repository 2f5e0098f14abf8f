from __future__ import annotations

import pytest

from quire.llm import license_scan
from tests.llm.helpers import frame

MIT = """MIT License

Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the notice.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
CASES = ((MIT, "MIT/text,MIT/title-plain"), (GPL.format(":", 3), "GPL-3.0/notice"), (GPL.format(";", 2), "GPL-2.0/notice"), (BSD, "BSD/grant"), (ISC, "ISC/grant"), (APACHE, "Apache-2.0/header"))


@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// "])
def test_wrapped_texts(spark, prefix):
    texts = ["".join(prefix + line for line in text.splitlines(keepends=True)) for text, _ in CASES]
    texts += [x.replace("\n", "\r\n") for x in texts] + [MIT.split("\n\n")[2].replace("sell\n", "sell\nother words\n"), "a\nReleased under\nthe MIT License", "\nreleased under the mit license or not"]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])).collect()}
    rules = [got[i].rules for i in range(len(texts))]
    assert rules == [r for _, r in CASES] * 2 + ["", "MIT/short", ""]
    assert got[0].license_ids == "mit_title_paren mit_grant mit_notice" and got[1].license_ids == "gpl_free gpl_hope gpl_see"
