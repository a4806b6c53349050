"""Entire licence texts, from the files in ``license_texts``, in the forms in which they usually stand.

Each text is taken with and without its title, with and without the appendix on how to apply it, and with the
appendix' copyright line as a blank or filled in (canonical texts have no filled-in copyright lines).
"""

from __future__ import annotations

import re
from pathlib import Path

FOLDER = Path(__file__).parent / "license_texts"
_GNU = "Everyone is permitted to copy"
_APPLY = "How to Apply These Terms"
_END = "END OF TERMS AND CONDITIONS"
# Identifier, file, where the text begins behind its title, where its appendix begins.
LONG = (
    ("Apache-2.0", "Apache-2.0", "TERMS AND CONDITIONS FOR USE", "APPENDIX:"),
    ("Apache-2.0", "Apache-2.0-spdx", "TERMS AND CONDITIONS FOR USE", "APPENDIX:"),
    ("Artistic-1.0-Perl", "Artistic-1.0-Perl", "Preamble", None),
    ("CC-BY-SA-4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public", "Creative Commons is not a party"),
    ("CC0-1.0", "CC0-1.0", "Statement of Purpose", None),
    ("GFDL-1.2", "GFDL-1.2", _GNU, "ADDENDUM:"),
    ("GFDL-1.3", "GFDL-1.3", _GNU, "ADDENDUM:"),
    ("GPL-1.0", "GPL-1.0", _GNU, "Appendix: " + _APPLY),
    ("GPL-2.0", "GPL-2.0", _GNU, _APPLY),
    ("GPL-2.0", "GPL-2.0-spdx", _GNU, _APPLY),
    ("GPL-3.0", "GPL-3.0", _GNU, _APPLY),
    ("GPL-3.0", "GPL-3.0-spdx", _GNU, _APPLY),
    ("LGPL-2.0", "LGPL-2.0", _GNU, _APPLY),
    ("LGPL-2.1", "LGPL-2.1", _GNU, _APPLY),
    ("LGPL-3.0", "LGPL-3.0", _GNU, None),
    ("MPL-1.1", "MPL-1.1", "1. Definitions", "EXHIBIT A -"),
    ("MPL-2.0", "MPL-2.0", "1. Definitions", "Exhibit A - "),
    ("NCSA", "NCSA", "Permission is hereby granted", None),
    ("OFL-1.1", "OFL-1.1", "PREAMBLE", None),
)
# Identifier (also the file, which has no title) and usual titles.
SHORT = (
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD")),
    ("BSD-2-Clause", ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "BSD License", "The BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License", "The BSD License")),
    ("BSL-1.0", ("Boost Software License - Version 1.0 - August 17th, 2003",)),
    ("Unlicense", ("The Unlicense", "Unlicense")),
    ("Zlib", ("zlib License", "The zlib License", "zlib/libpng License")),
)
_OLD_ADDRESS = (r"51\s+Franklin\s+St(reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA")
# Other spellings in which a text was published.
SPELLINGS = {
    "GPL-2.0": (_OLD_ADDRESS, (r"GNU\s+Lesser\s+General", "GNU Library General")),
    "GPL-3.0": ((r"licenses/why-not-lgpl", "philosophy/why-not-lgpl"),),
    "LGPL-2.0": (_OLD_ADDRESS,),
    "LGPL-2.1": (_OLD_ADDRESS,),
    "BSD-2-Clause": ((r"SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE", "SHALL <COPYRIGHT HOLDER> BE"),),
    "BSD-3-Clause": ((r"SHALL\s+THE\s+COPYRIGHT\s+HOLDER\s+OR\s+CONTRIBUTORS\s+BE", "SHALL <COPYRIGHT HOLDER> BE"),),
}
#: The names under which the BSD text speaks of its holder.
HOLDERS = ("the copyright holder", "the copyright holders", "the <organization>", "the author", "the University")


def read(name: str) -> str:
    return (FOLDER / f"{name}.txt").read_text(encoding="utf-8")


def spelled(name: str, text: str) -> list[str]:
    texts = [text]
    for pattern, other in SPELLINGS.get(name, ()):
        texts += [re.sub(pattern, other, t) for t in texts]
    return texts


def long_forms(text: str, body: str, appendix: str | None) -> list[str]:
    tails = [text]
    if appendix:
        front = text[: text.rindex(appendix)]
        tails += [front, front.replace(_END, ""), re.sub(r"(?m)^.*Copyright (\[yyyy\]|\{yyyy\}) .*$", "", text)]
    return [form for tail in tails for form in (tail, tail[tail.index(body) :])]


def short_forms(text: str, titles: tuple[str, ...]) -> list[str]:
    named = [text.replace("the copyright holder nor", f"{holder} nor") for holder in HOLDERS]
    listed = [form for t in named for form in (t, re.sub(r"(?m)^\s*[0-9][.)]\s", "", t), re.sub(r"(?m)^(\s*)([0-9])\.", r"(\2)", t))]
    return [form for t in listed for form in (t, *(f"{title}\n{t}" for title in titles))]


def entire_texts() -> tuple[tuple[str, str], ...]:
    """All forms as (identifier, text), each once."""
    rows = [(name, form) for name, file, body, appendix in LONG for t in spelled(name, read(file)) for form in long_forms(t, body, appendix)]
    rows += [(name, form) for name, titles in SHORT for t in spelled(name, read(name)) for form in short_forms(t, titles)]
    return tuple(dict.fromkeys(rows))
