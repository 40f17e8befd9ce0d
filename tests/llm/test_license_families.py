"""Recall and precision of the licence scan on wordings that are no template."""

from sparkmine.llm import licenses as L

HELD_OUT = {
    "AGPL": ["Licensed under the AGPLv3 or later.", "The server is free software under the GNU Affero General Public License.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "Code is AGPL-3.0 licensed.", "It is published under GNU AGPL v3."],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "This library is Apache-2.0 licensed.", "The code in this repository is covered by the Apache License, Version 2.0.", "licensed under the apache 2.0 license", "You may use it under the Apache License 2.0.", "See the Apache License, Version 2.0, for details"],
    "Artistic-2.0": ["The Artistic License 2.0", "This module may be used under the Artistic License.", "Perl code under the Artistic License 2.0", "License: Artistic License v2"],
    "BSD": ["BSD 2-Clause License", "BSD 3-Clause License", "The code is under a BSD-style license.", "This package is BSD-3-Clause licensed", "It is made available under the New BSD License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Use, modification and distribution are subject to the Boost Software License, Version 1.0.", "The headers are under the Boost Software License.", "Distributed under the Boost License"],
    "CC-BY": ["CC BY 4.0", "Text available under CC BY 4.0", "All articles are CC BY 4.0 unless noted.", "Except where otherwise noted, content is licensed under a Creative Commons Attribution 4.0 International license", "This is an open access article under the CC BY license", "Published under a Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "(c) Acme, CC BY-NC 4.0", "Photos are licensed under CC BY-NC 4.0", "This is an open access article under the CC BY-NC-ND license", "Distributed under the Creative Commons Attribution-NonCommercial License", "Slides: CC BY-NC-SA 4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Text is available under the Creative Commons Attribution-ShareAlike License", "Images are licensed CC BY-SA 3.0.", "Our documentation is CC BY-SA 4.0.", "Content under CC BY-SA unless stated"],
    "CC0": ["CC0 1.0 Universal", "The data set is CC0 1.0.", "Dedicated to the public domain under CC0 1.0 Universal", "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this data set.", "License: CC0-1.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "Available under the Eclipse Public License v2.0.", "This plug-in is made available under the terms of the Eclipse Public License 2.0", "EPL-2.0 licensed", "See the Eclipse Public License for more"],
    "GPL": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "Released under the GPLv3.", "GPL-3.0 license", "This game is licensed under the GNU GPL v2.", "It is distributed under the GNU General Public License.", "SPDX-License-Identifier:GPL-3.0-or-later", "You should have received a copy of the GNU General Public License along with this program.", "Our plugin is under the GPLv2 or later"],
    "ISC": ["ISC License", "The ISC License (ISC)", "Released under the ISC license.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", "It is licensed under the ISC License"],
    "LGPL": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "Licensed under the LGPLv3.", "This library is distributed under the GNU Lesser General Public License.", "LGPL-2.1 licensed library", "You should have received a copy of the GNU Lesser General Public License along with this library.", "The bindings are under the GNU LGPL."],
    "MIT": ["MIT License", "The MIT License (MIT)", "This library is released under the MIT License.", "MIT licensed, see the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy", "Source code is available under the MIT license.", "Licensed under MIT.", "The theme is under the MIT licence."],
    "MPL-2.0": ["MPL 2.0", "the Mozilla Public License, version 2.0.", "Mozilla Public License Version 2.0", "This add-on is licensed under the MPL 2.0", "Subject to the Mozilla Public License.", "If a copy of the MPL was not distributed with this file"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "The code is released under the Unlicense.", "Licensed under The Unlicense", "License: Unlicense"],
    "Zlib": ["zlib License", "Available under the zlib license.", "It uses the zlib/libpng license", "This software is provided 'as-is', without any express or implied warranty."],
}
CLEAN = [
    "A driver must carry the license at all times.", "The public library opened a new hall.", "He got a general idea of the public mood.", "The attribution of the painting is not certain.",
    "They walked to the common and sat under the old tree.", "The terms of the lease were hard.", "Students of the MIT built a small boat.", "The Apache helicopter landed on the field.",
    "A solar eclipse is visible to the public.", "She has an artistic mind and a license to teach.", "Permission to land was granted to the pilot.", "A copy of the letter was given to any person who asked.",
    "The law allows a person to copy a page.", "Software version 2.0 is out now.", "The boost in sales was free of charge.", "International law is subject to change.",
    "The author has waived the fee.", "The works of the foundation are known.", "The file was copied to the archive in version 3.", "You can obtain one at the desk.",
    "The fishing license is available under the counter.", "No person may use the road without permission.", "The bar was licensed under the old law.", "The film was released under a new title.",
]
PROSE = "the man under the tree had a work of art and the public saw it in the hall of the city under the sun"


def test_recall_and_precision_on_held_out_wordings(spark):
    wanted = [(f, line) for f, lines in HELD_OUT.items() for line in lines]
    docs = [(i, f"{PROSE} {i} times\n{PROSE} in year {i}") for i in range(100)] + [(1000 + i, f"{PROSE}\n{line}") for i, (_, line) in enumerate(wanted)] + [(2000 + i, line) for i, line in enumerate(CLEAN)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = L.train(spark, df.where("doc_id < 100").select("text"))
    found = {}
    for r in L.scan(df, model).where(L.F.col("family") != L.UNKNOWN).collect():
        found.setdefault(r["doc_id"], set()).add(r["family"])
    right = [i for i, (f, _) in enumerate(wanted) if found.get(1000 + i) == {f}]
    wrong = {line: found[1000 + i] for i, (f, line) in enumerate(wanted) if found.get(1000 + i, {f}) != {f}}
    clean = {line: found[2000 + i] for i, line in enumerate(CLEAN) if 2000 + i in found}
    missed = [line for i, (_, line) in enumerate(wanted) if 1000 + i not in found]
    print(f"recall {len(right)} of {len(wanted)}; missed {missed}; wrong {wrong}; clean {clean}")
    assert not any(d < 100 for d in found)
    assert len(right) >= 0.9 * len(wanted)
    assert len(right) >= 0.95 * (len(right) + len(wrong) + len(clean))
