"""Which elements the style sheets of a page hide: display and visibility by selector, cascade and screen."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

# The screen that media queries are asked for, in pixels; an em is 16 of them.
WIDTH, HEIGHT, EM = 1280, 800, 16
_COMMENT, _STRING = re.compile(r"/\*.*?(?:\*/|\Z)", re.S), re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_MARK = re.compile(r"[{};]")
_BRACE = re.compile(r"[{}]")
_PART = re.compile(r"\s*(>?)\s*(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
_NAMES = re.compile(r"[.#][\w-]+")
_WIDTHS = re.compile(r"\(\s*(min|max)-(width|height)\s*:\s*([\d.]+)(px|r?em)\s*\)")
_DISPLAY, _VISIBILITY = (re.compile(rf"(?:^|;)\s*{name}\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I) for name in ("display", "visibility"))


def _feature(text: str) -> bool:
    if text in ("", "all", "screen", "only screen", "only all", "(orientation: landscape)", "(orientation:landscape)"):
        return True
    if m := _WIDTHS.fullmatch(text):
        size = float(m[3]) * (1 if m[4] == "px" else EM)
        own = WIDTH if m[2] == "width" else HEIGHT
        return own >= size if m[1] == "min" else own <= size
    return False


def on_screen(query: str) -> bool:
    """Whether a list of media queries holds on the screen; a feature that is not known does not."""
    def holds(one: str) -> bool:
        one = " ".join(one.split())
        negated = one.startswith("not ")
        return all(map(_feature, one.removeprefix("not ").split(" and "))) != negated

    return any(map(holds, query.lower().split(",")))


def style_rules(css: str):
    """(selectors, declarations) of the rules that hold on a screen, in order."""
    at = start = 0
    while m := _MARK.search(css, at):
        at = m.end()
        if m[0] != "{":
            start = at
            continue
        head, depth = css[start:m.start()].strip(), 1
        while depth and (b := _BRACE.search(css, at)):
            depth += 1 if b[0] == "{" else -1
            at = b.end()
        body = css[m.end():at - 1] if not depth else css[m.end():]
        at = at if not depth else len(css)
        start = at
        name = re.match(r"@[\w-]*", head)
        if not name:
            yield head, body
        elif name[0].lower() in ("@supports", "@layer") or name[0].lower() == "@media" and on_screen(head[6:]):
            yield from style_rules(body)


def _declared(pattern: re.Pattern, body: str) -> tuple[bool, str] | None:
    """The declaration that counts among several: the last important one, else the last."""
    found = [(bool(m[2]), m[1].lower()) for m in pattern.finditer(body)]
    return max(enumerate(found), key=lambda x: (x[1][0], x[0]))[1] if found else None


def _selector(text: str):
    """(combinator, tag, marks) from left to right, or None for a selector with parts that are not known here."""
    parts, at, text = [], 0, text.strip()
    while at < len(text):
        m = _PART.match(text, at)
        if m.end() == at or not (m[2] or m[3]) or parts and not m[1] and not text[at].isspace():
            return None
        parts.append((m[1], "" if m[2] in (None, "*") else m[2].lower(), frozenset(_NAMES.findall(m[3]))))
        at = m.end()
    # Every element is below these two.
    while len(parts) > 1 and parts[0][1] in ("html", "body") and not parts[0][2] and not parts[1][0]:
        parts = parts[1:]
    return parts or None


def _below(parts: Sequence, above: Sequence) -> bool:
    """Whether the ancestors (the nearest last, with name and marks) fit all but the last part of a selector."""
    if len(parts) == 1:
        return True
    direct, (_, tag, marks) = parts[-1][0], parts[-2]
    for k in range(len(above) - 1, -1, -1):
        if tag in ("", above[k].name) and marks <= above[k].marks and _below(parts[:-1], above[:k]):
            return True
        if direct:
            return False
    return False


class Styles:
    """The rules on display and visibility, looked up by what an element has to be at least."""

    def __init__(self):
        self.rules: dict[str, list] = defaultdict(list)
        self.order = 0

    def add(self, css: str) -> None:
        for selectors, body in style_rules(_STRING.sub("''", _COMMENT.sub("", css))):
            said = (_declared(_DISPLAY, body), _declared(_VISIBILITY, body))
            if said == (None, None):
                continue
            for text in selectors.split(","):
                if parts := _selector(text):
                    names = [x for _, _, marks in parts for x in marks]
                    weight = (sum(x[0] == "#" for x in names), sum(x[0] == "." for x in names), sum(bool(tag) for _, tag, _ in parts))
                    _, tag, marks = parts[-1]
                    self.order += 1
                    self.rules[min(marks) if marks else tag].append((weight, self.order, parts, said))

    def of(self, name: str, marks: frozenset[str], above: Sequence, inline: str) -> list[str | None]:
        """[display, visibility] of an element: important ones first, then the style attribute, then weight, then order."""
        told = [[], []]
        if self.rules:
            for key in ("", name, *marks):
                for weight, order, parts, said in self.rules.get(key, ()):
                    if parts[-1][1] in ("", name) and parts[-1][2] <= marks and _below(parts, above):
                        for k in (0, 1):
                            if said[k]:
                                told[k].append((said[k][0], False, weight, order, said[k][1]))
        if inline:
            for k, pattern in enumerate((_DISPLAY, _VISIBILITY)):
                if found := _declared(pattern, inline):
                    told[k].append((found[0], True, (), 0, found[1]))
        return [max(x)[4] if x else None for x in told]
