"""A small feed on disk, in the layout the readers expect."""

import tarfile
from pathlib import Path

PLANNED = {
    "w1/2509221901/berlin_s_dkreuz_timetable.xml": (
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<timetable station="Berlin Südkreuz">'
        '<s id="a"><tl c="S" n="1" o="08" t="p" f="N"/><ar pt="2509221939" pp="1" l="S1" ppth="X &amp; Y"/>'
        '<dp pt="2509221941" pp="1" l="S1"/><dp pt="2509221959" pp="2" l="S1"/></s>'
        '<s id="b"><dp pt="250922194"/></s>'
        '<s id="c"><tl c="RE" n="7"/><ar/></s>'
        '<s><tl c=" S " n="1" o="08"/><ar pt="2502301200"/></s>'
        '<s id="d"><tl c="S" n="1" o="08" t="g"/></s>'
        "</timetable>"
    ),
    "w1/2509222001/empty_timetable.xml": "<timetable/>",
    "w1/2509222001/cut_timetable.xml": '<timetable station="Berlin Cut"><s id="z"><ar pt="2509',
    "w2/2509292001/no station+name_timetable.xml": (
        '<timetable><s id="e"><tl c="S" n="" o=""/><dp pt="202509292005"/></s></timetable>'
    ),
}
CHANGES = {
    "w1/2509221915/berlin_s_dkreuz_timetable.xml": (
        '<timetable station="Berlin Südkreuz"><s id="a"><m/><ar ct="2509221940" cs=" C " cp="" l="S1" dis="1"/>'
        '<dp ct="2509221950" cp="4"/><dp ct="2509221955" clt="2509221900" cs="p"/></s></timetable>'
    ),
    "w1/2509221930/berlin_s_dkreuz_timetable.xml": (
        '<timetable station="Berlin Südkreuz"><s id="a"><ar ct="2509221937" cp="3"/></s></timetable>'
    ),
    "w1/2509230015/berlin_s_dkreuz_timetable.xml": (
        '<timetable station="Berlin Südkreuz"><s id="a"><ar ct="2509230100"/></s></timetable>'
    ),
    "w3/2510061915/x_timetable.xml": '<timetable station="X"><s id="q"><ar ct="2510061940"/></s></timetable>',
}


def write_feed(root: Path) -> str:
    for feed, files in (("timetables", PLANNED), ("timetable_changes", CHANGES)):
        for name, text in files.items():
            path = root / feed / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text, encoding="utf-8")
            (path.parent / "notes.txt").write_text("not a timetable")
    return str(root)


def write_archives(plain: Path, root: Path) -> str:
    """One ``<period>.tar.gz`` per period folder."""
    for feed in ("timetables", "timetable_changes"):
        (root / feed).mkdir(parents=True)
        for period in (plain / feed).iterdir():
            with tarfile.open(root / feed / f"{period.name}.tar.gz", "w:gz") as archive:
                for path in sorted(period.rglob("*")):
                    archive.add(path, arcname=f"./{path.relative_to(period)}", recursive=False)
    return str(root)
