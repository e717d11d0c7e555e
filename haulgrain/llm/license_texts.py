"""Templates of licences for operator 5: whole texts, notices, and words that a version must have.

Whole texts lie in the folder ``licenses``, one file for each SPDX identifier. AGPL-3.0 and BSD-2-Clause are made
from their near relations; the versions' words tell them apart. There are no whole texts of the CC-BY family.
"""

from __future__ import annotations

import re
from importlib import resources
from typing import NamedTuple


class Template(NamedTuple):
    license: str
    text: str
    #: Whole text of a licence, not a notice.
    full: bool = False
    #: Regular expression that the words of a unit must have, lower case and joined by a space.
    needs: str = ""


_GNU = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
_GNU_VERSIONS = [("GPL", "1.0"), ("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")]
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _number(version: str) -> str:
    """Of the words of a version: '2 0' may leave out the 0, '2 1' may not leave out the 1."""
    major, minor = version.split(".")
    return rf"{major}(?: 0)?\b(?! [1-9]\b)" if minor == "0" else rf"{major} {minor}\b"


def _notices() -> list[Template]:
    out = []
    for short, version in _GNU_VERSIONS:
        name, number = f"{short}-{version}", version.removesuffix(".0")
        titles = [_GNU[short]] + (["Library General Public License"] if name == "LGPL-2.0" else [])
        for title in titles:
            words = title.lower()
            # The first version named after the title; or "version 3 of the GNU ...".
            needs = (rf"\bgnu {words}\b(?:(?!\b(?:version|v) ?[0-9]).){{0,300}}\b(?:version |v ?){_number(version)}"
                     rf"|\b(?:version |v ?){_number(version)} of the gnu {words}\b"
                     rf"|\b{short.lower()} ?(?:version |v ?)?{_number(version)}")
            program = (f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {title} "
                       f"as published by the Free Software Foundation, either version {number} of the License")
            for text in (f"This work is licensed under the GNU {title}, version {number}.", f"GNU {title}, version {number}.",
                         f"Licensed under the GNU {short} v{number}.", program,
                         program + ", or (at your option) any later version.",
                         program + f", or (at your option) any later version. This program is distributed in the hope that it will be useful, but "
                         f"WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
                         f"See the GNU {title} for more details."):
                out.append(Template(name, text, needs=needs))
    for kind, title in _CC.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            words = [re.sub(r"[^a-z]+", " ", x.lower()) for x in (kind, title)]
            needs = rf"\b(?:{words[0]}|{words[1]})(?: international| license| licence| version| v){{0,4}} ?{_number(version)}"
            out += [Template(f"CC-{kind}-{version}", text, needs=needs) for text in (
                f"Licensed under CC {kind} {version}.", f"This work is licensed under a Creative Commons {title} {version} International License.")]
    apache = r"\bapache license (?:version )?2(?: 0)?\b(?! [1-9]\b)|\bapache 2(?: 0)?\b"
    out += [
        Template("Apache-1.1", "Licensed under the Apache License, Version 1.1.", needs=r"\bapache (?:software )?license (?:version )?1 1\b"),
        Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", needs=apache),
        Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                               "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0", needs=apache),
        Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                               "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                               "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                               "See the License for the specific language governing permissions and limitations under the License.", needs=apache),
        Template("MIT", "Released under the MIT License.", needs=r"\bmit\b"),
        Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                        "documentation files, to deal in the Software without restriction", needs=r"\bpermission is hereby granted\b"),
        Template("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                                 "that the following conditions are met", needs=r"\bredistribution and use\b"),
        Template("BSD-2-Clause", "Released under the BSD 2-Clause License.", needs=r"\bbsd 2\b|\b2 clause bsd\b"),
        Template("BSD-3-Clause", "Released under the BSD 3-Clause License.", needs=r"\bbsd 3\b|\b3 clause bsd\b"),
        Template("ISC", "Released under the ISC License.", needs=r"\bisc\b"),
        Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
                 needs=r"\bpermission to use\b"),
        Template("EPL-1.0", "Licensed under the Eclipse Public License, Version 1.0.", needs=rf"\beclipse public license (?:version |v ?)?{_number('1.0')}"),
        Template("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0.", needs=rf"\beclipse public license (?:version |v ?)?{_number('2.0')}"),
        Template("CC0-1.0", "To the extent possible under law, the author has waived all copyright. Released under CC0 1.0.",
                 needs=r"\bcc0\b|\bwaived all copyright\b"),
        Template("CC0-1.0", "Released under CC0 1.0.", needs=r"\bcc0\b"),
        Template("Unlicense", "This is free and unencumbered software released into the public domain.", needs=r"\bunencumbered\b"),
        Template("proprietary", "All rights reserved.", needs=r"\ball rights reserved\b"),
    ]
    for version in ("1.1", "2.0"):
        out += [Template(f"MPL-{version}", text, needs=rf"\bmozilla public license (?:version |v ?)?{_number(version)}") for text in (
            f"This Source Code Form is subject to the terms of the Mozilla Public License, v. {version}.",
            f"This Source Code Form is subject to the terms of the Mozilla Public License, v. {version}. If a copy of the MPL was not distributed "
            f"with this file, You can obtain one at http://mozilla.org/MPL/{version}/.",
            f"Licensed under the Mozilla Public License, version {version}.")]
    return out


#: Words that whole texts must have besides their cosine. Titles stand within the first words of a file.
_TITLE = r"^(?:\S+ ){0,80}?"
_THIRD = r"\bneither the names? of\b|\bname of .{1,200}\bmay not be used to endorse\b|\bmay be used to endorse\b"
_FULL_NEEDS = {
    "MIT": r"\bpermission is hereby granted\b", "ISC": r"\bpermission to use copy modify\b", "Zlib": r"\baltered source versions\b",
    "Unlicense": r"\bunencumbered\b", "BSD-3-Clause": _THIRD, "BSD-2-Clause": rf"^(?!.*(?:{_THIRD}|advertising materials)).*\bredistribution and use\b",
    "Apache-2.0": _TITLE + r"apache license version 2 0\b", "CC0-1.0": r"\bcc0 1 0\b|\bcc0\b",
    "Artistic-1.0-Perl": r"\bartistic license\b(?! 2)", "MPL-1.1": _TITLE + r"mozilla public license version 1 1\b",
    "MPL-2.0": _TITLE + r"mozilla public license version 2 0\b",
    "GFDL-1.2": _TITLE + r"gnu free documentation license version 1 2\b", "GFDL-1.3": _TITLE + r"gnu free documentation license version 1 3\b",
    "LGPL-2.0": _TITLE + r"gnu library general public license version 2\b(?! [1-9]\b)",
    "LGPL-2.1": _TITLE + r"gnu lesser general public license version 2 1\b", "LGPL-3.0": _TITLE + r"gnu lesser general public license version 3\b",
    "GPL-1.0": _TITLE + r"gnu general public license version 1\b", "GPL-2.0": _TITLE + r"gnu general public license version 2\b",
    "GPL-3.0": _TITLE + r"gnu general public license version 3\b", "AGPL-3.0": _TITLE + r"gnu affero general public license version 3\b",
}


def standard() -> list[Template]:
    """The templates, read on the driver."""
    texts = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in resources.files("haulgrain.llm").joinpath("licenses").iterdir()
             if f.name.endswith(".txt")}
    texts["BSD-2-Clause"] = re.sub(r"3\. Neither.*?permission\.", "", texts["BSD-3-Clause"], flags=re.DOTALL)
    texts["AGPL-3.0"] = texts["GPL-3.0"].replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    return _notices() + [Template(name, text, True, _FULL_NEEDS[name]) for name, text in sorted(texts.items())]
