"""Notices of public licences, as templates for ``license_index``."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    """A notice, the label of its licence and the phrases that must stand in it."""

    label: str
    text: str
    phrases: tuple[str, ...]


#: Phrases whose places are all reported, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Wording of the notices that the licences ask authors to use.
TEMPLATES = [
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so",
        ("hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template("mit", "under the MIT license", ("mit license",)),
    Template(
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template("apache-2.0", "under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
        ("gnu general public license", "either version 2 of the license"),
    ),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("gnu general public license", "either version 3 of the license"),
    ),
    Template("gpl-2.0", "GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl-3.0", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software",
        ("in no event will the authors be held liable",),
    ),
    Template("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ("boost software license version 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("cc0-1.0", "waived all copyright and related or neighboring rights CC0 1.0 Universal", ("cc0 1 0",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("attribution sharealike 4 0",)),
    Template("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("attribution noncommercial 4 0",)),
    Template("cc-by-4.0", "licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
]
