"""Mixed XML content to Markdown pieces. A piece is a plain string or an Atom; the masked text and the Markdown both come from
the same pieces, so restoring the mask gives the Markdown by construction."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from xml.etree.ElementTree import Element

HREF = "{http://www.w3.org/1999/xlink}href"
# Tags and patterns of the article markup.
OWN_UNITS = ("fig", "supplementary-material", "table-wrap")
BETWEEN_CITATIONS = r"[,;–\-  ]*"
SPECIES = r"[A-Z][a-z]+(?: [a-z]+){0,2}\.?"
FORMULA = r"\$\$(.*?)\$\$|\$(.*?)\$"
DISPLAY_GAP = r" *(\n\n\$\$.*?\$\$\n\n) *"
TRAILING_BRACKET = r"(?:%3e|>)+$"


@dataclass(frozen=True)
class Atom:
    """Something that stays whole. kind: V variable, N name, C citation, F figure or other reference, R section reference,
    L link, U sub- or superscript, M formula. cites: the text of a lone citation, which groups join."""

    kind: str
    md: str
    rid: str | None = None
    cites: str | None = None


Pieces = list  # of str | Atom


def squeeze(text: str) -> str:
    return re.sub(r"[ \t\r\n]+", " ", text)


def whole_text(el: Element) -> str:
    return "".join(el.itertext())


def nodes(el: Element):
    """Text and child elements in reading order; empty texts are left out."""
    if el.text:
        yield el.text
    for child in el:
        yield child
        if child.tail:
            yield child.tail


def tidy_url(url: str) -> str:
    return re.sub(TRAILING_BRACKET, "", url.strip(), flags=re.IGNORECASE)


def markdown(pieces: Pieces) -> str:
    return "".join(p.md if isinstance(p, Atom) else squeeze(p) for p in pieces)


def formula(el: Element) -> Atom:
    holder = next(el.iter("tex-math"), None)
    found = re.search(FORMULA, whole_text(holder) if holder is not None else "", re.DOTALL)
    display = el.tag == "disp-formula"
    if found:
        body = (found[1] or found[2]).strip()
        return Atom("M", f"\n\n$${body}$$\n\n" if display else f"${body}$")
    body = squeeze(whole_text(el)).strip()
    return Atom("M", f"\n\n```\n{body}\n```\n\n" if display else f"`{body}`")


def superscript_citation(el: Element) -> str | None:
    """The text of a superscript that holds nothing but citations and separators."""
    parts = list(nodes(el))
    cites = [p for p in parts if not isinstance(p, str) and p.tag == "xref" and p.get("ref-type") == "bibr"]
    rest = [p for p in parts if isinstance(p, str)]
    if cites and len(cites) + len(rest) == len(parts) and all(re.fullmatch(BETWEEN_CITATIONS, t) for t in rest):
        return "".join(squeeze(p if isinstance(p, str) else whole_text(p)) for p in parts)
    return None


def reference(el: Element) -> Pieces:
    text, kind = squeeze(whole_text(el)), el.get("ref-type")
    if kind == "sec":
        return [Atom("R", text, rid=el.get("rid"))]
    if kind == "bibr":
        return [Atom("C", f"[{text}]", cites=text)]
    return [Atom("F", text)]


def scripted(el: Element) -> Pieces:
    cited = superscript_citation(el) if el.tag == "sup" else None
    if cited is not None:
        return [Atom("C", f"[{cited}]")]
    return [Atom("U", f"<{el.tag}>{markdown(inline(el))}</{el.tag}>")]


def italic(el: Element) -> Pieces:
    text = whole_text(el).strip()
    if len(text) <= 3 and " " not in text:
        return [Atom("V", f"*{markdown(inline(el))}*")]
    if re.fullmatch(SPECIES, text):
        return [Atom("N", f"*{text}*")]
    return ["*", *inline(el), "*"]


def link(el: Element) -> Pieces:
    text = tidy_url(whole_text(el))
    return [Atom("L", f"[{text}]({tidy_url(el.get(HREF, text))})")]


#: How an element turns into pieces; others give the pieces of what they hold.
RENDER = {
    "disp-formula": lambda el: [formula(el)],
    "inline-formula": lambda el: [formula(el)],
    "sub": scripted,
    "sup": scripted,
    "ext-link": link,
    "xref": reference,
    "italic": italic,
    "bold": lambda el: ["**", *inline(el), "**"],
    "monospace": lambda el: [Atom("N", f"`{whole_text(el)}`")],
    **dict.fromkeys(OWN_UNITS, lambda el: []),
}


def inline(el: Element) -> Pieces:
    """Pieces of an element's content, citation groups folded."""
    out: list[tuple[Pieces, bool]] = []  # (pieces, is a lone citation)
    for node in nodes(el):
        if isinstance(node, str):
            out.append(([node], False))
        else:
            out.append((RENDER.get(node.tag, inline)(node), node.tag == "xref" and node.get("ref-type") == "bibr"))
    return fold_groups(out)


def fold_groups(parts: list[tuple[Pieces, bool]]) -> Pieces:
    """'[' citation (separator citation)* ']' becomes one citation. A regular expression over a sketch of the parts finds the
    groups: o text that ends in '[', c citation, s separator, e text that starts with ']', t other text, x anything else."""

    def mark(k: int) -> str:
        pieces, cite = parts[k]
        if cite:
            return "c"
        if len(pieces) != 1 or not isinstance(pieces[0], str):
            return "x"
        text = pieces[0]
        if text.startswith("]"):
            return "b" if text.rstrip().endswith("[") and len(text) > 1 else "e"
        if text.rstrip().endswith("["):
            return "o"
        return "s" if re.fullmatch(BETWEEN_CITATIONS, text) else "t"

    sketch = "".join(map(mark, range(len(parts))))
    groups = {m.start(1): m.end(1) for m in re.finditer(r"(?<=[ob])(c(?:sc)*)(?=[eb])", sketch)}
    out: Pieces = []
    at, closing = 0, False
    while at < len(parts):
        if at in groups:
            inner = "".join(squeeze(p) if isinstance(p, str) else p.cites for pieces, _ in parts[at : groups[at]] for p in pieces)
            out.append(Atom("C", f"[{inner}]"))
            at, closing = groups[at], True
            continue
        pieces = parts[at][0]
        if sketch[at] in "oeb":
            text = pieces[0][1:] if closing else pieces[0]
            if at + 1 in groups:
                text = text.rstrip()[:-1]
            pieces = [text]
        out += pieces
        at, closing = at + 1, False
    return out


class Protector:
    """Splits plain text at protected terms (longest first, whole words) and patterns."""

    def __init__(self, terms=(), patterns=()):
        alternatives = [re.escape(t) for t in sorted(terms, key=len, reverse=True)] + list(patterns)
        self.pattern = re.compile(r"(?<!\w)(?:" + "|".join(alternatives) + r")(?!\w)") if alternatives else None

    def split(self, text: str) -> Pieces:
        text = squeeze(text)
        if not self.pattern:
            return [text]
        out, at = [], 0
        for m in self.pattern.finditer(text):
            out += [text[at : m.start()], Atom("N", m[0])]
            at = m.end()
        return [*out, text[at:]]


def finish(text: str) -> str:
    return re.sub(DISPLAY_GAP, r"\1", text, flags=re.DOTALL).strip()


def masked(el: Element, protector: Protector) -> tuple[str, dict, str]:
    """(text with placeholders, their spans, Markdown) of an element."""
    numbers: Counter[str] = Counter()
    spans, text, md = {}, [], []
    for piece in inline(el):
        for p in [piece] if isinstance(piece, Atom) else protector.split(piece):
            if isinstance(p, Atom):
                numbers[p.kind] += 1
                key = f"⟦{p.kind}{numbers[p.kind]}⟧"
                spans[key] = {"type": p.kind, "md": p.md, "rid": p.rid}
                text.append(key)
                md.append(p.md)
            else:
                text.append(p)
                md.append(p)
    return finish("".join(text)), spans, finish("".join(md))
