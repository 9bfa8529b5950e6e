"""Licence expressions of any length."""

from __future__ import annotations

from docledger.llm.license_scan import Scanner


def test_long_expression():
    names = [f"LicenseRef-{k}" for k in range(2000)] + ["GPL-2.0-only"]
    text = "SPDX-License-Identifier:\t" + " AND ".join(names) + "\nISC"
    found = Scanner()(text.encode())
    assert set(found["labels"]) == {n.lower() for n in names}
    assert found["permissive"] is False and len(found["expressions"]) == 1


def test_line_ends_expression():
    found = Scanner()(b"SPDX-License-Identifier: (MIT OR\nApache-2.0)\nSPDX-License-Identifier: ISC OR (BSD-3-Clause\n AND GPL-2.0)")
    assert found["labels"] == ["isc"] and found["expressions"] == ["isc"]


def test_evidence():
    """What is no identifier gives no label; standard notices and names do."""
    cases = {
        "SPDX-License-Identifier: see LICENSE file": [],
        "SPDX-License-Identifier: the": [],
        "SPDX-License-Identifier: MIT OR nonsense": [],
        "SPDX-License-Identifier: LicenseRef-Own AND GPL-2.0-or-later": ["gpl-2.0-or-later", "licenseref-own"],
        "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note": ["gpl-2.0-only with linux-syscall-note"],
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": ["mit"],
        "Redistribution and use in source and binary forms, with or without modification, are permitted": ["bsd"],
        "GPLv3 license": ["gpl-3"],
        "under GNU GPL v2": ["gpl-2"],
        "Creative Commons Attribution 4.0 International": ["cc-by-4.0"],
        "Creative Commons Attribution-NonCommercial-ShareAlike 3.0": ["cc-by-nc-sa-3.0"],
        "the GNU General Public License, either version 2 of the License": ["gpl-2-or-later"],
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of": ["lgpl-2.1-or-later"],
        "GNU General Public License": ["gpl"],
        "(c) 2020. All rights reserved.": [],
    }
    found = {t: Scanner()(t.encode()) for t in cases}
    assert {t: r["labels"] for t, r in found.items()} == cases
    # A name leaves more doubt than a notice, a notice more than an expression; nothing found is no licence.
    score = {t: r["score"] for t, r in found.items()}
    names = [v for t, v in score.items() if t in ("GPLv3 license", "GNU General Public License")]
    assert max(names) < score["Redistribution and use in source and binary forms, with or without modification, are permitted"] < score["SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note"] < 1
    assert score["(c) 2020. All rights reserved."] == 0 == score["SPDX-License-Identifier: the"]
