"""Licence texts as they stand in files: wrapped, and with the text going on."""

import textwrap

import pytest

from millrace.llm.licences import TEMPLATES, Templates
from tests.llm.edge_rows import prose

WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY DAMAGES WHATSOEVER RESULTING FROM THE USE OF THIS SOFTWARE."
)
BSD = TEMPLATES["BSD"][0] + (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
    "the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
) + WARRANTY
FILES = {
    "BSD": BSD,
    "ISC": TEMPLATES["ISC"][0] + " " + WARRANTY,
    "MIT": TEMPLATES["MIT"][2] + " " + WARRANTY,
    "Apache-2.0": TEMPLATES["Apache-2.0"][1] + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations.",
    "GPL-3.0": TEMPLATES["GPL-3.0"][1] + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
}


@pytest.mark.parametrize("width", [40, 72, 79, 10_000])
@pytest.mark.parametrize("name", FILES)
def test_wrapped_files(name, width):
    wrapped = textwrap.fill(FILES[name], width)
    text = prose(3, 30) + "\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n" + wrapped + "\n\n" + prose(4, 30)
    found = Templates(TEMPLATES, 0.8).scan(text)
    assert set(found) <= {name, "All-Rights-Reserved"} and name in found, found
    _, start, stop = found[name]
    assert wrapped.split()[0] in " ".join(text.split("\n")[start:stop])
