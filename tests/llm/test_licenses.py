import pytest

from clickmart.llm.licenses import KEYWORD, RULES, SENTENCES, scan

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal in the Software without restriction.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
CASES = [
    (MIT, "MIT"),
    (APACHE, "Apache-2.0"),
    ("Some words\nLicensed under CC BY-NC 4.0.\nMore words.", "CC-BY-NC-4.0"),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", "MIT Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Released under the MIT License.\n\nReleased under the MIT License.", "MIT"),
    ("Copyright 2001 Me. All rights reserved.", "Proprietary"),
    ("This is licensed under terms nobody knows.", "Unknown"),
    ("A driving license is needed here.", ""),
    ("plain text", ""),
    ("", ""),
    (None, ""),
    ("word " * 50_000 + "\nReleased under the MIT License.", "MIT"),
]


def test_known_texts(spark):
    rows = [(n, text, "old") for n, (text, _) in enumerate(CASES)]
    found = scan(spark.createDataFrame(rows, "doc_id long, text string, licences string")).collect()
    assert {r.doc_id: r.licences for r in found} == {n: name for n, (_, name) in enumerate(CASES)}


def test_sequence_of_a_whole_licence(spark):
    row = scan(spark.createDataFrame([(1, MIT)], "doc_id long, text string")).first()
    assert row.sentence_ids == "Copyright MITperm MITnotice AsIs NoLiability"


def test_plan_has_no_python_and_no_exchange(documents, no_documents):
    plan = scan(documents.sparkSession.createDataFrame(documents.rdd, documents.schema))._jdf.queryExecution().toString()
    assert "Python" not in plan.split("== Physical Plan ==")[1].replace("ExistingRDD", "") and "Exchange" not in plan
    assert scan(no_documents).count() == 0


def test_every_known_sentence_has_a_keyword_and_a_rule():
    import re

    used = {name for _, names in RULES for name in names}
    assert used <= {name for name, _ in SENTENCES}
    for _, pattern in SENTENCES:
        assert re.search(KEYWORD, pattern.replace("licen[cs]e", "license").replace("(is|are)", "is")) or "cc" in pattern or "warrant" in pattern


@pytest.mark.parametrize("name", [name for name, _ in SENTENCES])
def test_identifiers_are_words(name):
    assert " " not in name and "<" not in name


def licences_of(spark, texts):
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r.licences for r in sorted(rows, key=lambda r: r.doc_id)]


def gnu(name, version, work="program", stop=";", pad=""):
    return f"""{pad}This {work} is free software{stop} you can redistribute it and/or modify
{pad}it under the terms of the GNU {name} as published by
{pad}the Free Software Foundation{stop} either version {version} of the License, or
{pad}(at your option) any later version.
{pad}
{pad}This {work} is distributed in the hope that it will be useful,
{pad}but WITHOUT ANY WARRANTY; without even the implied warranty of
{pad}MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
{pad}GNU {name} for more details.
{pad}
{pad}You should have received a copy of the GNU {name}
{pad}along with this {work}; if not, see <https://www.gnu.org/licenses/>.
"""


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
   following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice in the documentation.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, MERCHANTABILITY ARE DISCLAIMED.
"""
NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
   products derived from this software without specific prior written permission.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages.

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original.
"""
NOTICES = [
    *[
        (gnu(f"{kind}General Public License", version, work, stop, pad), licence)
        for kind, version, work, licence in [
            ("", "2", "program", "GPL-2.0"), ("", "3", "program", "GPL-3.0"), ("Lesser ", "2.1", "library", "LGPL-2.1"),
            ("Lesser ", "3", "program", "LGPL-3.0"), ("Affero ", "3", "program", "AGPL-3.0"),
        ]
        for stop in ";:,"
        for pad in ("", " * ")
    ],
    ("It is under the GNU General Public License as published by the Free Software Foundation; version 2.", "GPL-2.0"),
    ("SPDX-License-Identifier: MIT", "SPDX"),
    ("// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note\n#include <a/b.h>\nint f(int, int);", "SPDX"),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) */\nint x;", "SPDX"),
    ("words.\n# SPDX-License-Identifier: BSD-3-Clause\n\nReleased under the MIT License: see below.", "SPDX MIT"),
    ("SPDX-License-Identifier: MIT Licensed under the Apache License, Version 2.0.", "SPDX Apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at https://www.eclipse.org/legal/epl-2.0/", "EPL-2.0"),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", "BSL-1.0"),
    (BSD % "", "BSD-2-Clause"),
    (BSD % NAME, "BSD-3-Clause"),
    (ZLIB, "Zlib"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice appear in all copies.", "ISC"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    (APACHE, "Apache-2.0"),
    (MIT, "MIT"),
]


def test_spdx_lines_and_standard_notices(spark):
    found = licences_of(spark, [text for text, _ in NOTICES])
    assert [(text, name) for (text, _), name in zip(NOTICES, found, strict=True)] == NOTICES


EXAMPLES = {
    "SPDX": "SPDX-License-Identifier: MIT",
    "Copyright": "Copyright 2020 Someone",
    "AllRights": "All rights reserved",
    "ApacheRef2.0": "Licensed under the Apache License, Version 2.0",
    "ApacheObtain": "You may obtain a copy of the License at http://www.apache.org",
    "ApacheNot": "You may not use this file except in compliance with the License",
    "ApacheAsIs": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS',
    "ApacheSee": "See the License for the specific language governing permissions and limitations under the License",
    "MITref": "Released under the MIT license",
    "MITperm": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MITnotice": "The above copyright notice and this permission notice shall be included in all copies",
    "AsIs": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND",
    "NoLiability": "In no event shall the authors be liable",
    "ISCperm": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "BSDref": "Released under the BSD 3-Clause License",
    "BSDpre": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "BSDsource": "Redistributions of source code must retain the above copyright notice",
    "BSDbinary": "Redistributions in binary form must reproduce the above copyright notice",
    "BSDname": "Neither the name of it nor others may be used to endorse or promote products",
    "BSDasIs": "This software is provided by the authors as is and any express or implied warranties",
    "AGPLref3": "GNU Affero General Public License version 3",
    "LGPLref2.1": "GNU Lesser General Public License version 2.1",
    "LGPLref3": "GNU Lesser General Public License version 3",
    "GPLref2": "GNU General Public License version 2",
    "GPLref3": "GNU General Public License version 3",
    "AGPLpub": "GNU Affero General Public License as published by the Free Software Foundation",
    "LGPLpub": "GNU Lesser General Public License as published by the Free Software Foundation",
    "GPLpub": "GNU General Public License as published by the Free Software Foundation",
    "Version2.1": "version 2.1",
    "Version2": "either version 2",
    "Version3": "version 3",
    "GPLnoWarranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "GPLcopy": "You should have received a copy of the GNU General Public License",
    "MPLref2.0": "Mozilla Public License, v. 2.0",
    "EPLref2.0": "Eclipse Public License 2.0",
    "BoostRef": "Boost Software License, Version 1.0",
    "ZlibAsIs": "This software is provided 'as-is', without any express or implied warranty",
    "ZlibOrigin": "The origin of this software must not be misrepresented",
    "ZlibAltered": "Altered source versions must be plainly marked as such",
    "CC0ref": "Released under CC0 1.0 by the author",
    "CCBYNCSAref4.0": "Licensed under CC BY-NC-SA 4.0",
    "CCBYNCref4.0": "Licensed under CC BY-NC 4.0",
    "CCBYSAref4.0": "Licensed under CC BY-SA 4.0",
    "CCBYref4.0": "Licensed under CC BY 4.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "PublicDomain": "It is placed in the public domain",
    "OtherLicence": "Licensed under terms nobody knows",
}


def test_an_example_of_every_identifier_is_found(spark):
    assert list(EXAMPLES) == [name for name, _ in SENTENCES]
    rows = [(name, f"{text}.") for name, text in EXAMPLES.items()]
    found = {r.doc_id: r.sentence_ids for r in scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert found == {name: name for name in EXAMPLES}
    texts = ["Dedicated with Creative Commons Zero v1.0 Universal.", "Released under CC0 1.0 by the author."]
    assert licences_of(spark, texts) == ["CC0-1.0", "CC0-1.0"]
