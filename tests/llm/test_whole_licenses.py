"""Licence scan: short templates, licences worded alike, full texts."""

from popweave.llm import license_scan

GNU = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public "
       "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version. "
       "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.")
BSD = ("Copyright (c) 2019 Some One. Redistribution and use in source and binary forms, with or without modification, are permitted "
       "provided that the following conditions are met: * Redistributions of source code must retain the above copyright notice, "
       "this list of conditions and the following disclaimer. * Redistributions in binary form must reproduce the above copyright "
       "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
       "distribution. {}This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
       "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose "
       "are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
       "special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; "
       "loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in "
       "contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this "
       "software, even if advised of the possibility of such damage.")
THIRD = ("* Neither the name of Some One nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission. ")


def test_licences_by_name(spark):
    full = dict(license_scan.known_licenses())
    rows = [(1, "A page of text. (c) 2020. ALL RIGHTS RESERVED", {"LicenseRef-All-Rights-Reserved"}), (2, "all rights", set()),
            (3, GNU.format("", 2), {"GPL-2.0"}), (4, GNU.format("Affero ", 3), {"AGPL-3.0"}), (5, GNU.format("", 3), {"GPL-3.0"}),
            (6, BSD.format(""), {"BSD-2-Clause"}), (7, BSD.format(THIRD), {"BSD-3-Clause"}), (8, "Opening. " + full["GPL-2.0"], {"GPL-2.0"}),
            (9, full["ISC"] + " Closing words.", {"ISC"}),
            (10, "Released under the MIT License. All rights reserved. " + GNU.format("", 2), {"MIT", "LicenseRef-All-Rights-Reserved", "GPL-2.0"})]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    templates = spark.createDataFrame(license_scan.known_licenses(), "license string, text string")
    got = {i: set() for i, _, _ in rows}
    for r in license_scan.scan(docs, templates).collect():
        got[r.id].add(r.license)
    assert got == {i: want for i, _, want in rows}
