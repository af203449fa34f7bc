"""Small page-history files for tests."""

import bz2


def revision(
    id="1", parent=None, time="2020-01-02T03:04:05Z", who="<ip>10.0.0.1</ip>",
    comment=None, text="words", text_element=None,
):
    lines = [f"<id>{id}</id>"] if id is not None else []
    if parent is not None:
        lines.append(f"<parentid>{parent}</parentid>")
    if time is not None:
        lines.append(f"<timestamp>{time}</timestamp>")
    if who is not None:
        lines.append(f"<contributor>{who}</contributor>")
    if comment is not None:
        lines.append(comment)
    lines.append(text_element or f'<text bytes="1" xml:space="preserve">{text}</text>')
    lines.append("<sha1>q</sha1>")
    return "    <revision>\n      " + "\n      ".join(lines) + "\n    </revision>\n"


def page(id="7", title="Some page", ns="0", revisions=(), more=""):
    parts = []
    if title is not None:
        parts.append(f"    <title>{title}</title>\n")
    if ns is not None:
        parts.append(f"    <ns>{ns}</ns>\n")
    if id is not None:
        parts.append(f"    <id>{id}</id>\n")
    return "  <page>\n" + "".join(parts) + more + "".join(revisions) + "  </page>\n"


def export(*pages, version="0.10"):
    return (
        f'<mediawiki xmlns="http://www.mediawiki.org/xml/export-{version}/" '
        f'version="{version}" xml:lang="en">\n  <siteinfo>\n    <sitename>S</sitename>\n'
        '    <namespaces><namespace key="0" case="first-letter" /></namespaces>\n  </siteinfo>\n'
        + "".join(pages)
        + "</mediawiki>\n"
    )


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".bz2":
        with bz2.open(path, "wt", encoding="utf-8", newline="") as out:
            out.write(text)
    else:
        with open(path, "w", encoding="utf-8", newline="") as out:
            out.write(text)
    return str(path)
