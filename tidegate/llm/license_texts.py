"""Wordings of licenses that a scan looks for."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False
    exact: bool = False


# Phrases whose places are counted, and their labels.
BASE = [Template("mit", "mit license", True, True), Template("apache", "apache license", True, True),
        Template("gpl", "general public license", True, True)]

# Short names of licenses, found word by word.
NAMES = [Template(label, text, exact=True) for label, text in [
    ("lgpl", "lesser general public license"),
    ("agpl", "affero general public license"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("bsd", "bsd license"),
    ("bsd", "2 clause bsd"),
    ("bsd", "3 clause bsd"),
    ("isc", "isc license"),
    ("cc-by", "cc by 4 0"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc0", "cc0 1 0"),
]]

# The public wording of notices and clauses, found with small differences.
NOTICES = [Template(label, text) for label, text in [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
               "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
            "version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]]

TEMPLATES = BASE + NAMES + NOTICES
