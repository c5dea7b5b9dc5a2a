"""Every text of the catalogue is found on a line of its own, and as a file with what files have around it."""

from pathlib import Path

import hard
import pytest

from collatio.llm import licenses

PUBLISHED = Path("/usr/share/common-licenses")
TITLES = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "0BSD": "Zero-Clause BSD", "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003", "Zlib": "zlib License"}


def test_each_known_text_on_a_line(spark):
    rows = [(i, "before\n" + t.replace("\n", " ") + "\nafter", "", "") for i, (_, t) in enumerate(licenses.KNOWN)]
    got = {r.doc_id: r.notice_licenses for r in licenses.scanned(hard.documents(spark, rows)).collect()}
    assert got == {i: [name] for i, (name, _) in enumerate(licenses.KNOWN)}


def wrapped(text, width):
    out, line = [], ""
    for w in text.split(" "):
        if line and len(line) + len(w) > width:
            out.append(line)
            line = ""
        line = f"{line} {w}" if line else w
    return "\n".join([*out, line])


def test_stock_files(spark):
    texts = [(n, t) for n, t in licenses.KNOWN if len(t) > 400 and not t.startswith("Licensed")]
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Zlib", "BSL-1.0", "0BSD"} <= {n for n, _ in texts}
    rows, want = [], {}
    for n, t in texts:
        body = "\n\n".join(wrapped(p, 76) for p in t.split("\n"))
        for head in ("", f"{TITLES.get(n, '')}\n\nCopyright (c) 2021 Some One\n\n", "Copyright 1999, 2004 A B <a@b.c>\nAll rights reserved.\n\n"):
            want[len(rows)] = n
            rows.append((len(rows), head + body, "", ""))
        want[len(rows)] = n
        rows.append((len(rows), body.replace("\n1. ", "\n * 1. ").replace(" license", " licence"), "", ""))
        want[len(rows)] = None
        rows.append((len(rows), body + "\nand more", "", ""))
    got = {r.doc_id: r.text_license for r in licenses.scanned(hard.documents(spark, rows)).collect()}
    assert got == want


@pytest.mark.skipif(not PUBLISHED.exists(), reason="no published licence files here")
def test_published_files(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause", "GFDL-1.3": "GFDL-1.3"}
    rows = [(i, (PUBLISHED / f).read_text(), "", "") for i, f in enumerate(names)]
    rows += [(100 + i, "\n".join(line.strip().upper() for line in t.split("\n")), "", "") for i, t, *_ in rows]
    got = {r.doc_id: r.text_license for r in licenses.scanned(hard.documents(spark, rows)).collect()}
    assert got == {i + k: n for i, n in enumerate(names.values()) for k in (0, 100)}
