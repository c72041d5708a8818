"""Leaf blocks of a page: stretches of text between block-level tags, with features
of the tags around them and of their text."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre search "
    "section select summary table tbody td textarea tfoot th thead tr ul".split()
)
HIDDEN_TAGS = frozenset("head title script style template noscript svg math iframe object audio video canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Open tags that a tag ends, as their end tags may be left out.
ENDS = {
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
# Tags an end left out doesn't reach beyond.
WALLS = frozenset("ul ol dl table article section div nav aside footer header main form body select".split())
SECTIONS = frozenset("article section nav aside footer header main form".split())
_NAME = re.compile("[a-z]+")


@dataclass
class Block:
    text: str
    features: list[str]


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.around: Counter = Counter()
        self.hidden = self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            tag = next((t for t, _ in reversed(self.open) if t in BLOCK_TAGS), "none")
            features = [f for f, n in self.around.items() if n > 0]
            self.blocks.append(Block(text, [f"tag:{tag}", *features, *self._near(), *_text_features(text, self.linked)]))
        self.parts, self.linked = [], 0

    def _near(self) -> list[str]:
        """The nearest section or named tag around the block, and the outermost section."""
        found = ["near:none"]
        for tag, (_, *names) in reversed(self.open):
            if names or tag in WALLS:
                found = [f"near:{tag}", *(f"near-{n}" for n in names)]
                break
        return [*found, "top:" + next((tag for tag, _ in self.open if tag in SECTIONS), "none")]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.flush()
            while self.open and self.open[-1][0] in ("head", "title"):
                self._close()
            ended = ENDS.get(tag, {"p"})
            for at in range(len(self.open) - 1, -1, -1):
                name = self.open[at][0]
                if name in ended:
                    while len(self.open) > at:
                        self._close()
                elif name in WALLS or name in BLOCK_TAGS and name not in ended:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        names = []
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += [f"name:{n}" for n in _NAME.findall(value.lower())]
        features = (f"in:{tag}", *names)
        self.open.append((tag, features))
        self.around.update(features)
        self.hidden += tag in HIDDEN_TAGS
        self.links += tag == "a"

    def _close(self):
        tag, features = self.open.pop()
        self.around.subtract(features)
        self.hidden -= tag in HIDDEN_TAGS
        self.links -= tag == "a"

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        if any(t == tag for t, _ in self.open):
            while self.open[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def _step(name: str, value: float, cuts: tuple[float, ...]) -> str:
    return f"{name}:{sum(value >= c for c in cuts)}"


def _text_features(text: str, linked: int) -> list[str]:
    size, found = len(text), text.count(" ") + 1
    features = [
        _step("chars", size, (15, 40, 80, 160, 320)),
        _step("words", found, (2, 4, 8, 16, 40)),
        _step("linked", linked / size, (0.01, 0.3, 0.8)),
        _step("stops", text.count(". ") + text.count("? ") + text.count("! "), (1, 3)),
        _step("commas", text.count(","), (1, 3)),
        _step("digits", sum(map(text.count, "0123456789")) / size, (0.01, 0.1, 0.3)),
    ]
    if text[-1] in ".!?…":
        features.append("ends")
    if "©" in text or "|" in text or "·" in text or "»" in text:
        features.append("sign")
    if text.isupper():
        features.append("capitals")
    return features


def blocks(html) -> list[Block]:
    """Blocks of a whole page, in order; none for a null or empty one."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.blocks
