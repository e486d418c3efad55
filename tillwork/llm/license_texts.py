"""Notices and operative paragraphs of public licenses."""

#: Labels of which one notice differs from another's by a word or two: the better match names the words.
FAMILIES = [{"gpl-2", "gpl-3", "lgpl-3", "agpl-3"}, {"cc-by-sa", "cc-by-nc", "cc-by"}, {"bsd", "bsd-3"}, {"mit", "isc"}]

# Wording of the licenses themselves, as (label, text).
TEMPLATES = [
    ("mit", "released under the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", "licensed under the Apache license version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                 "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-2", "this work is licensed under the GNU General Public License version 2"),
    ("gpl-3", "this work is licensed under the GNU General Public License version 3"),
    ("lgpl-3", "this work is licensed under the GNU Lesser General Public License version 3"),
    ("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
              "Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
              "Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl-3", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
               "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl-3", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
               "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer"),
    ("bsd-3", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("mpl-2", "subject to the terms of the Mozilla Public License version 2.0"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
              "not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("boost-1", "Distributed under the Boost Software License, Version 1.0"),
    ("all-rights-reserved", "all rights reserved"),
]
# Fixed values end.
