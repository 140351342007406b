"""A plain renderer to hold the extraction against: recursive, whole strings, a full grid per table."""
import re

from ledgerline.llm import html_text as H

WHITE = re.compile(r"[ \t\n\r\f]+")


def shown(node, visible):
    style = (node.attrs.get("style") or "").lower().replace(" ", "")
    if node.tag in H.UNSEEN or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" or "display:none" in style.split(";"):
        return None
    if node.tag == "dialog" and "open" not in node.attrs:
        return None
    for rule in style.split(";"):
        if rule in ("visibility:hidden", "visibility:collapse"):
            visible = False
        if rule == "visibility:visible":
            visible = True
    return visible


def events(children, visible, lists=(), pre=False):
    """Text, line ends, gaps and item marks in reading order."""
    out = []
    counter = lists[-1] if lists else None
    for c in children:
        if isinstance(c, str):
            if visible:
                out.append(("pre" if pre else "text", c))
            continue
        seen = shown(c, visible)
        if seen is None:
            continue
        inside = c.children
        if c.tag == "details" and "open" not in c.attrs:
            inside = [x for x in inside if isinstance(x, H.Node) and x.tag == "summary"][:1]
        if c.tag == "br":
            out.append(("break", None))
            continue
        apart = c.tag in H.APART and not (lists and c.tag in H.LISTS)
        edge = [("line", None)] * (c.tag in H.BLOCK) + [("gap", None)] * apart
        out += edge
        if c.tag == "table":
            for line in table(c, seen):
                out += [("pre", line), ("line", None)]
            out.append(("gap", None))
            continue
        if c.tag in H.LISTS:
            start = [int(c.attrs.get("start") or 1)] if c.tag == "ol" else [None]
            out += events(inside, seen, lists + (start,), pre)
        elif c.tag == "li":
            mark = "- "
            if counter and counter[0] is not None:
                counter[0] = int(c.attrs.get("value") or counter[0])
                mark = f"{counter[0]}. "
                counter[0] += 1
            out.append(("mark", "  " * max(0, len(lists) - 1) + mark))
            out += events(inside, seen, lists, pre)
        else:
            out += events(inside, seen, lists, pre or c.tag in H.VERBATIM)
        out += edge[:1] + ([("mark", "")] if c.tag == "li" else []) + edge[1:]
    return out


def text(children, visible):
    lines, line, gap, prefix = [], "", False, ""

    def end(keep=False):
        nonlocal line, gap, prefix
        if line.strip() or keep:
            if gap and lines:
                lines.append("")
            gap = False
            lines.append((prefix + line).rstrip())
            prefix = " " * len(prefix)
        line = ""
    for kind, s in events(children, visible):
        if kind == "line":
            end()
        elif kind == "gap":
            gap = True
        elif kind == "mark":
            prefix = s
        elif kind == "break":
            line = line.rstrip()
            end(keep=bool(line))
        elif kind == "pre":
            for i, part in enumerate(s.split("\n")):
                if i:
                    end(keep=True)
                line += part
        else:
            line = WHITE.sub(" ", (line + WHITE.sub(" ", s))) if not line.strip() else line + WHITE.sub(" ", s)
            line = re.sub(r" +", " ", line).lstrip(" ")
    end()
    return "\n".join(lines).strip("\n")


def table(node, visible):
    kids = [c for c in node.children if isinstance(c, H.Node) and shown(c, visible) is not None]
    out = [line for c in kids if c.tag == "caption" for line in text(c.children, shown(c, visible)).split("\n") if line]
    groups = {"thead": [], "tbody": [], "tfoot": []}
    loose = None
    for c in kids:
        if c.tag == "tr":
            if loose is None:
                loose = []
                groups["tbody"].append(loose)
            loose.append((c, shown(c, visible)))
        elif c.tag in groups:
            loose = None
            v = shown(c, visible)
            groups[c.tag].append([(r, shown(r, v)) for r in c.children if isinstance(r, H.Node) and r.tag == "tr" and shown(r, v) is not None])
    taken, cells, y = set(), [], 0
    for g in groups["thead"] + groups["tbody"] + groups["tfoot"]:
        for i, (row, v) in enumerate(g):
            x = 0
            for c in row.children:
                if not isinstance(c, H.Node) or c.tag not in ("td", "th") or shown(c, v) is None:
                    continue
                wide, high = int(c.attrs.get("colspan") or 1), int(c.attrs.get("rowspan") or 1)
                high = len(g) - i if high == 0 else min(high, len(g) - i)
                while (y, x) in taken:
                    x += 1
                taken |= {(y + dy, x + dx) for dy in range(high) for dx in range(wide)}
                cells.append((y, x, wide, high, WHITE.sub(" ", text(c.children, shown(c, v))).strip()))
                x += wide
            y += 1
    filled = {r for r, _, _, _, t in cells if t}
    rows = {r: sorted((x, wide, t if r == top else "") for top, x, wide, high, t in cells if top <= r < top + high) for r in sorted(filled)}
    used = sorted({x for row in rows.values() for x, _, _ in row})
    width = dict.fromkeys(used, 0)
    for x, wide, t in sorted((c for row in rows.values() for c in row), key=lambda c: c[1]):
        mine = [u for u in used if x <= u < x + wide]
        width[mine[-1]] += max(0, len(t) - sum(width[u] for u in mine) - 3 * (len(mine) - 1))
    for row in rows.values():
        out.append(" | ".join(t.ljust(sum(width[u] for u in used if x <= u < x + w) + 3 * (sum(x <= u < x + w for u in used) - 1)) for x, w, t in row).rstrip())
    return out


def visible_text(html):
    return text(H.parse(html).children, True) if html else ""
