from foliospark.llm.licenses import SENTENCES, TRIGGERS, scan


def test_every_sentence_has_a_trigger():
    assert all(any(t in s for t in TRIGGERS) for s in SENTENCES)


def test_rules_in_order_and_odd_rows(spark):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License. You may obtain a copy of the License at"),
        (2, "Released under the MIT License. All rights reserved.\nReleased under the MIT License."),
        (3, None),
        (4, ""),
        (5, "You may obtain a copy of the License at"),
        (6, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as licenses", "2 as t")).collect()}
    assert got[1].licenses == "Apache-2.0" and got[1].unmatched == ""
    assert got[2].licenses == "MIT,Proprietary"
    assert got[3].sentence_ids == got[4].sentence_ids == ""
    assert got[5].licenses == "" and got[5].unmatched == "ApacheCopy"
    assert scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Redistributions of source code must retain the above copyright notice, this
#    list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""


def test_wrapped_sentences_and_words_before(spark):
    rows = [(1, MIT), (2, BSD), (3, GPL), (4, "This file is released under the MIT License."), (5, "This file is not released under the MIT License."), (6, "licensed under\n\nthe MIT license"), (7, "All rights reserved\nreleased under the MIT License\nx")]
    got = {r.doc_id: r.licenses for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "BSD-2-Clause", 3: "GPL-3.0-or-later", 4: "MIT", 5: "", 6: "", 7: "MIT,Proprietary"}


MIT_END = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_END = """#
# THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
# AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
# IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
# DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
# FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
# DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
# SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
# CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
# OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
# OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
ISC = """// Permission to use, copy, modify, and/or distribute this software for any
// purpose with or without fee is hereby granted, provided that the above
// copyright notice and this permission notice appear in all copies.
//
// THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
// WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
// MERCHANTABILITY AND FITNESS.
"""


def test_whole_notices_and_odd_rows(spark):
    rows = [(1, MIT + MIT_END), (2, BSD + BSD_END), (3, APACHE), (4, ISC), (5, "// SPDX-License-Identifier: GPL-2.0-or-later"), (5, "// SPDX-License-Identifier: GPL-2.0-or-later"), (None, "x\n" * 200_000 + MIT), (6, "words and more words. " * 50_000)]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = [(str(r.doc_id), r.licenses, r.unmatched) for r in got]
    assert sorted(found) == sorted([("1", "MIT", ""), ("2", "BSD-2-Clause", ""), ("3", "Apache-2.0", ""), ("4", "ISC", ""), ("5", "GPL-2.0-or-later", ""), ("5", "GPL-2.0-or-later", ""), ("None", "MIT", ""), ("6", "", "")])
