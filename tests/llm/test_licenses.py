from re import _parser as parser

import pytest

from kpi_shift.llm import licenses
from tests.llm.helpers import clashing, documents

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice.
{}THIS SOFTWARE IS PROVIDED BY THE AUTHORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
ADVERT = "3. All advertising materials mentioning features or use of this software must say so.\n"
NAME = "4. Neither the name of X nor the names of its contributors may be used to endorse or promote products derived.\n"
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in it, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
CASES = {
    "words\nLicensed under CC BY-NC 4.0.\nmore words": ["CC-BY-NC-4.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
    "Released under the MIT License.": ["MIT"],
    "Licensed under the Apache License, Version 2.0.": ["Apache-2.0"],
    "RELEASED UNDER THE MIT LICENSE. And Licensed under CC BY 4.0.": ["CC-BY-4.0", "MIT"],
    BSD.format(""): ["BSD-2-Clause"],
    BSD.format(NAME): ["BSD-3-Clause"],
    BSD.format(ADVERT + NAME): ["BSD-4-Clause"],
    MIT: ["MIT"],
    "# SPDX-License-Identifier: LGPL-2.1-or-later\ncode": ["SPDX:lgpl-2.1-or-later"],
    "a licence is a nice thing, all warranties and permission aside": [],
    "": [],
}


def test_rules(spark):
    docs = clashing(documents(spark, [*CASES, None, MIT, MIT, "word " * 30_000 + ". Released under the MIT License."]))
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    wanted = [*CASES.values(), [], ["MIT"], ["MIT"], ["MIT"]]
    assert [rows[i].licenses for i in range(len(wanted))] == wanted
    assert rows[8].sentence_ids == ["<mitGrant>", "<mitNotice>", "<softwareAsIs>", "<noLiability>"]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert "Python" not in docs.sparkSession._jvm.PythonSQLUtils.explainString(licenses.scan_licenses(docs)._jdf.queryExecution(), "simple")


def needs(items, wanted):
    """Whether everything that a parsed pattern matches has one of ``wanted``, as a run of letters and letter classes."""
    run = []
    for op, value in [*items, (None, None)]:
        if str(op) in ("LITERAL", "IN"):
            run.append((op, value))
            continue
        named = [(str(o), str(v)) for o, v in run]
        if any(w == named[i : i + len(w)] for w in wanted for i in range(len(named))):
            return True
        # the parser takes what alternatives begin with out of them
        if str(op) == "BRANCH" and all(needs([*run, *part], wanted) for part in value[1]):
            return True
        if str(op) == "SUBPATTERN" and needs(value[3], wanted):
            return True
        run = []
    return False


@pytest.mark.parametrize("name, pattern", licenses.SENTENCES)
def test_no_known_sentence_can_do_without_its_needs(name, pattern):
    assert not any(c in "k " for n in licenses.NEEDS for c in n)  # the only letter that another one is lower-cased to
    wanted = [[(str(op), str(value)) for op, value in parser.parse(n)] for n in licenses.NEEDS]
    assert needs(parser.parse(pattern), wanted)


HEADERS = {
    "GPL-2.0-or-later": """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""",
    "LGPL-2.1-or-later": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.""",
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.""",
    "AGPL-3.0-or-later": """You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "MIT": "left-pad is MIT licensed.\nMIT licensed.",
    "EPL-2.0": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License v. 2.0 which is available at https://www.eclipse.org/legal/epl-2.0.""",
}


def test_headers_as_they_are_published(spark):
    docs = documents(spark, [f"import x\n\n{t}\n\ncode" for t in HEADERS.values()])
    rows = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()}
    assert [rows[i] for i in range(len(HEADERS))] == [[name] for name in HEADERS]


CC = "Released under CC {}."
EXAMPLES = {
    "apache2": ["Licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0, January 2004."],
    "apacheUse": ["You may not use this file except in compliance with the License."],
    "apacheCopy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apacheAsIs": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS.'],
    "mitGrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "mitNotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "softwareAsIs": ['The software is provided "as is", without warranty of any kind.'],
    "noLiability": ["In no event shall the authors be liable."],
    "mitName": ["Available under the MIT License.", "This package is MIT licensed."],
    "bsdGrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted."],
    "bsdSource": ["Redistributions of source code must retain the above copyright notice."],
    "bsdBinary": ["Redistributions in binary form must reproduce the above copyright notice."],
    "bsdAdvert": ["All advertising materials mentioning features or use of this software must say so."],
    "bsdName": ["Neither the name of X nor others may be used to endorse or promote products."],
    "bsdAsIs": ['This software is provided by the authors "as is" and any express or implied warranties are disclaimed.'],
    "bsd3Name": ["Released under the 3-Clause BSD License."],
    "bsd2Name": ["Released under the 2-Clause BSD License."],
    "iscGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "agpl3Plus": ["Under the GNU Affero General Public License, version 3 or any later version."],
    "lgpl3Plus": ["Under the GNU Lesser General Public License, version 3 or any later version."],
    "lgpl21Plus": ["Under the GNU Lesser General Public License, version 2.1 or later."],
    "gpl3Plus": ["Under the GNU General Public License, version 3 or any later version."],
    "gpl2Plus": ["Under the GNU General Public License, version 2 or any later version."],
    "agpl3": ["Under the GNU Affero General Public License, version 3."],
    "lgpl3": ["Under the GNU Lesser General Public License, version 3."],
    "lgpl21": ["Under the GNU Lesser General Public License, version 2.1."],
    "gpl3": ["Under the GNU General Public License, version 3."],
    "gpl2": ["Under the GNU General Public License, version 2."],
    "gplNoWarranty": ["This program is distributed in the hope that it will be useful, but without any warranty."],
    "gplDetails": ["See the GNU General Public License for more details."],
    "mpl2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v2.0."],
    "epl2": ["Under the terms of the Eclipse Public License v2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc0": ["This work is dedicated under Creative Commons Zero."],
    "ccByNcSa": [CC.format("BY-NC-SA 4.0")],
    "ccByNcNd": [CC.format("BY-NC-ND 4.0")],
    "ccByNc": [CC.format("BY-NC 4.0")],
    "ccBySa": [CC.format("BY-SA 4.0"), "Texts are available under Creative Commons Attribution-ShareAlike 3.0."],
    "ccByNd": [CC.format("BY-ND 4.0")],
    "ccBy": [CC.format("BY 4.0")],
    "allRights": ["All rights reserved.", "Copyright 2020 X. All Rights Reserved", "ALL\n\tRIGHTS RESERVED!"],
    "spdx": ["SPDX-License-Identifier: MIT"],
}


def test_every_known_sentence_is_found(spark):
    assert list(EXAMPLES) == list(dict.fromkeys(name for name, _ in licenses.SENTENCES))
    pairs = [(name, text) for name, texts in EXAMPLES.items() for text in texts]
    docs = documents(spark, [f"Some words before it.\n\n{text}\n\nSome words behind it." for _, text in pairs])
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for i, (name, text) in enumerate(pairs):
        assert [s.strip("<>").split(" ")[0] for s in rows[i].sentence_ids] == [name], text
    told = {text: rows[i].licenses for i, (_, text) in enumerate(pairs)}
    assert told["All rights reserved."] == ["proprietary"] and told[CC.format("BY-SA 4.0")] == ["CC-BY-SA-4.0"]
