"""License templates: fixed wording of public licenses and notices.

Mark-up: ``<optional>...</optional>`` may be missing; ``<any words="a-b"/>`` stands
for a to b words of any kind; ``<one>x | y</one>`` is one of the listed
wordings.  All else is mandatory.  Letter case, punctuation and line breaks
do not count, as in the words of the scan.
"""

# Fixed values: (label, template).
TEMPLATES = [
    ("mit", """
<optional>The MIT License</optional> <optional>MIT</optional>
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the <optional>"</optional>Software<optional>"</optional>), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, <optional>sublicense,</optional> and/or sell
copies of the Software, and to permit persons to whom the Software is
<optional>furnished</optional> to do so, subject to the following conditions:
The above copyright notice and this permission notice <optional>(including the next paragraph)</optional>
shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<any words="1-12"/> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional>
<one>the | an | a</one> MIT <one>license | licence</one>"""),
    ("isc", """
Permission to use, copy, modify, and<optional>/or</optional> distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <any words="1-12"/> DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL <any words="1-12"/> BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-2-clause", """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
<optional>1.</optional> Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer.
<optional>2.</optional> Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY <any words="1-20"/> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("bsd-3-clause", """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
<optional>1.</optional> Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer.
<optional>2.</optional> Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
<optional>3.</optional> Neither the name of <any words="1-20"/> nor the names of <optional>its</optional> <any words="0-3"/>
contributors may be used to endorse or promote products derived from this
software without specific prior written permission."""),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty.
In no event will <any words="1-8"/> be held liable for any damages arising from the use of
this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:"""),
    ("unlicense", """
This is free and unencumbered software released into the public domain.
<optional>Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.</optional>"""),
    ("apache-2.0", """
Licensed under the Apache License, Version 2.0 <optional>(the "License"); you may not use
this <one>file | work | software</one> except in compliance with the License. You may obtain a copy of the License at</optional>"""),
    ("apache-2.0", """
<one>released | distributed | available | published | covered</one> under <optional>the terms of</optional> the
Apache <optional>Software</optional> <one>license | licence</one> <optional>version</optional> 2.0"""),
    ("gpl-2.0", """
under the terms of the GNU General Public License as published by the Free Software Foundation;
<optional>either</optional> version 2 <optional>of the License</optional> <optional>, or (at your option) any later version</optional>"""),
    ("gpl-3.0", """
under the terms of the GNU General Public License as published by the Free Software Foundation,
<optional>either</optional> version 3 <optional>of the License</optional> <optional>, or (at your option) any later version</optional>"""),
    ("gpl-2.0", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional> the
GNU General Public <one>license | licence</one> <optional>(GPL)</optional> <one>version | v</one> 2 <optional>or <optional>any</optional> later</optional>"""),
    ("gpl-3.0", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional> the
GNU General Public <one>license | licence</one> <optional>(GPL)</optional> <one>version | v</one> 3 <optional>or <optional>any</optional> later</optional>"""),
    ("lgpl-2.1", """
under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;
either version 2.1 of the License <optional>, or (at your option) any later version</optional>"""),
    ("cc-by", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional>
<optional><one>a | the</one></optional> <one>CC BY | Creative Commons Attribution</one> <optional><one>license | licence</one></optional>
<one>4.0 | 3.0 | 2.0</one> <optional>International</optional> <optional><one>license | licence</one></optional>"""),
    ("cc-by-nc", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional>
<optional><one>a | the</one></optional> <one>CC BY NC | Creative Commons Attribution NonCommercial</one> <optional><one>license | licence</one></optional>
<one>4.0 | 3.0 | 2.0</one> <optional>International</optional> <optional><one>license | licence</one></optional>"""),
    ("cc-by-sa", """
<one>released | licensed | distributed | available | published | covered</one> under <optional>the terms of</optional>
<optional><one>a | the</one></optional> <one>CC BY SA | Creative Commons Attribution ShareAlike</one> <optional><one>license | licence</one></optional>
<one>4.0 | 3.0 | 2.0</one> <optional>International</optional> <optional><one>license | licence</one></optional>"""),
]

# Fixed values: (phrase, label).
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
