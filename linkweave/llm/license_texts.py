"""Notices by which a text names its license."""

from __future__ import annotations

def _gnu(program: str, license: str, version: str) -> str:
    return (
        f"This {program} is free software; you can redistribute it and/or modify it under the terms "
        f"of the GNU {license} as published by the Free Software Foundation; either version "
        f"{version} of the License, or (at your option) any later version."
    )


# What BSD licenses share, and the clauses that tell them apart.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:"
)
_BSD_CLAUSES = (
    _BSD + " 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce "
    "the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)

# Wordings of well-known license notices, by SPDX identifier; BSD is what all
# of its licenses begin with.
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
    ),
    (
        "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("BSD", _BSD),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    ("BSD-2-Clause", _BSD_CLAUSES + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CLAUSES + _BSD_NAMES + _BSD_DISCLAIMER),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    ("GPL-2.0-or-later", _gnu("program", "General Public License", "2")),
    ("LGPL-2.0-or-later", _gnu("library", "Library General Public License", "2")),
    ("LGPL-2.1-or-later", _gnu("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0-or-later", _gnu("program", "Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _gnu("program", "Affero General Public License", "3")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    ("ISC", "Licensed under the ISC License."),
    (
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
