from test_license_scans import scan

CASES = {
    "Licensed under CC BY 4.0": ["CC-BY-4.0 short notice"],
    "Licensed under CC BY-SA 4.0": ["CC-BY-SA-4.0 short notice"],
    "Licensed under CC BY-NC 4.0": ["CC-BY-NC-4.0 notice"],
    "Licensed under CC BY-NC-SA 4.0": ["CC-BY-NC-SA-4.0 short notice"],
    "This work is licensed under the GNU General Public License, version 2": ["GPL-2.0 notice"],
    "This work is licensed under the GNU General Public License, version 3": ["GPL-3.0 notice"],
    "This work is licensed under the GNU Lesser General Public License, version 3": ["LGPL-3.0 notice"],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": ["CC-BY-SA-4.0 notice"],
    "Released under the BSD License": ["BSD notice"],
    "Released under the ZPL License": [],
    "Licensed under the Apache License, Version 2.1": [],
}


def test_a_license_does_not_count_as_its_sibling(frame):
    got = scan(frame, [f"Some words before. {text}. And some after." for text in CASES])
    assert [[r[1] for r in got if r[0] == i] for i in range(len(CASES))] == list(CASES.values())
