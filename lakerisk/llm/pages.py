"""Main text of web pages by a bidirectional LSTM over the blocks of a page.

A page is read as the sequence of its leaf blocks, each with its tag path (tags, classes and ids of all open
elements, and the names of inline elements that hold the whole block) and its text. Every block becomes a vector of
all its hashed path tokens, all its hashed words and a few figures;
the network reads the whole sequence in both directions and labels each block, so a label depends on the
document around it. The blocks labelled as article are joined.

The network is trained on a bounded sample of pages. Its labels come from the pages' own markup: what stands
in an article is text, what stands in one of the ``FURNITURE`` elements is not. As a corpus may know few kinds
of furniture, further pieces are put into copies of the training pages, in the article too, and now and then
the article is a plain division; in half of the copies, divisions of neutral names are nested around and in both.

Defined cases: a null or empty page, or one without article text, gives an empty string; broken markup is read
as far as it goes (open elements are closed by what follows, a bare ``<`` is text); an address may be null;
``<br>`` is white space; pages are read whole whatever their length; repeated rows give repeated results;
columns of the input other than the text are kept, but for ones named like an output column; without any
page to learn from, the network is trained on made pages alone; an empty table stays empty.
"""

import zlib
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready
from lakerisk.llm.training import sigmoid

PAGES = 120  # pages learned from
HEAD_CHARS, LEARNED = 100_000, 200  # of a longer page, learned from: its beginning, and of that a stretch of blocks
COPIES, STRETCH = 12, 12  # of each training page, with other furniture; blocks in a copy
PATH, WORDS, FIGURES, HIDDEN = 1024, 512, 6, 12
SALT = "1309"  # chosen so that the usual tags and names of furniture share few places with those of text
EPOCHS, BATCH, RATE = 12, 24, 0.02
CELLS = 16_384  # blocks read at once, padding included

# Fixed values of HTML.
HIDDEN_TAGS = frozenset("script style template noscript svg math iframe object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES = {  # a start tag that ends an open element of these
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl div section article header footer nav aside main form table blockquote pre".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
# What is not the article: elements, and words of classes and ids.
FURNITURE_TAGS = "nav header footer aside form menu dialog button select textarea title".split()
FURNITURE_NAMES = (
    "ad ads advert advertisement sponsored promo banner sidebar side-bar menu navigation navbar breadcrumb breadcrumbs header masthead footer "
    "cookie cookie-notice consent notice alert popup modal newsletter subscribe signup share social related recommended comments comment "
    "comment-list replies reply respond disqus widget pagination login search search-form".split()
)
NEUTRAL = "container wrapper row col inner outer layout grid box section-body page-wrap site root clearfix flex column block panel module".split()
LEAVES = ("p", "li", "div", "span", "h3", "td")


class Blocks(HTMLParser):
    """The leaf blocks of a page: ``path`` tokens, ``text``, and how much of the text is links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[tuple[str, ...], str, float]] = []
        self.open: list[tuple[str, tuple[str, ...], int]] = []
        self.parts: list[str] = []
        self.linked = self.hidden = self.count = 0
        self.around: list[tuple] | None = None  # inline elements that hold all of the block so far

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(token for tag, tokens, _ in self.open if tag not in INLINE for token in tokens)
            path += tuple(token for _, tokens, _ in self.around or () for token in tokens[1:])
            self.blocks.append((path, text, min(1.0, self.linked / len(text))))
        self.parts, self.linked, self.around = [], 0, None

    def close_to(self, tags, barrier=()):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in tags:
                self.hidden -= sum(tag in HIDDEN_TAGS for tag, _, _ in self.open[at:])
                del self.open[at:]
                return
            if self.open[at][0] in barrier:
                return

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag in ("br", "wbr"):
                self.parts.append(" " if tag == "br" else "")
                return
        else:
            self.flush()
            if tag in CLOSES:
                inside = ("ul", "ol", "table", "dl", "article", "section", "div", "body") if tag in ("li", "dt", "dd", "tr", "td", "th") else ()
                self.close_to(CLOSES[tag], inside)
        if tag in VOID:
            return
        names = [w for key, value in attrs if key in ("class", "id", "role") and value for w in value.lower().split()]
        self.count += 1
        self.open.append((tag, (tag, *("." + w for w in names)), self.count))
        self.hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        self.close_to((tag,), ("table", "article") if tag in INLINE or tag == "p" else ())

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if any(tag == "a" for tag, _, _ in self.open[-3:]):
                self.linked += len(data)
            if not data.isspace() and self.around != []:
                inline = [element for element in self.open if element[0] in INLINE and len(element[1]) > 1]
                self.around = inline if self.around is None else [element for element in self.around if element in inline]

    def finish(self):
        self.close()
        self.flush()
        return self.blocks


def blocks_of(html: str) -> list[tuple[tuple[str, ...], str, float]]:
    reader = Blocks()
    reader.feed(html)
    return reader.finish()


@lru_cache(100_000)
def _spots(path: tuple[str, ...]) -> np.ndarray:
    """Two places in the vector for each token of a path; names are taken apart at their hyphens too."""
    tokens = set(path)
    for token in path:
        if token[0] == ".":
            tokens.update("." + w for w in token[1:].replace("_", "-").split("-"))
    codes = [zlib.crc32((SALT + token).encode()) for token in tokens]
    return np.array([c for code in codes for c in (code % PATH, (code >> 16) % PATH)], np.int64)


@lru_cache(100_000)
def _word(word: str) -> int:
    return zlib.crc32(word.encode()) % WORDS


def _path_part(paths) -> np.ndarray:
    out = np.zeros((len(paths), PATH), np.float32)
    for i, path in enumerate(paths):
        out[i, _spots(path)] = 1
    return out


def _text_part(blocks, low: int, total: int) -> np.ndarray:
    """Words and figures of blocks that stand from place ``low`` on among ``total``."""
    out = np.zeros((len(blocks), WORDS + FIGURES), np.float32)
    for i, (_, text, linked) in enumerate(blocks):
        words = text.split()
        codes = np.fromiter(map(_word, words), np.int64, len(words))
        out[i, :WORDS] = np.bincount(codes, minlength=WORDS) / max(10, len(words))
        out[i, WORDS:] = (
            log1p(len(text)) / 6, linked, log1p(len(words)) / 4, text[-1] in ".!?", (low + i) / total, text[0].isupper(),
        )
    return out


def vectors(blocks) -> np.ndarray:
    return np.concatenate([_path_part([path for path, _, _ in blocks]), _text_part(blocks, 0, len(blocks))], axis=1)


def _projected(blocks, low: int, high: int, weights: np.ndarray) -> np.ndarray:
    """``vectors(blocks)[low:high] @ weights``, some blocks at a time and each path once."""
    out = np.zeros((max(0, min(high, len(blocks)) - low), weights.shape[1]), np.float32)
    for at in range(0, len(out), 256):
        own = blocks[low + at:min(low + at + 256, high)]
        known: dict[tuple[str, ...], int] = {}
        rows = [known.setdefault(path, len(known)) for path, _, _ in own]
        out[at:at + len(own)] = (_path_part(list(known)) @ weights[:PATH])[rows] + _text_part(own, low + at, len(blocks)) @ weights[PATH:]
    return out


def _states(inputs, mask, wh, h, c):
    """States of one direction from its inputs, and the last two to go on from; nothing is kept for a gradient."""
    out = np.zeros((*mask.shape, HIDDEN), np.float32)
    for t in range(len(mask)):
        gates = inputs[t] + h @ wh
        i, f, o = np.split(sigmoid(gates[:, :3 * HIDDEN]), 3, axis=1)
        m = mask[t][:, None]
        new = f * c + i * np.tanh(gates[:, 3 * HIDDEN:])
        c = m * new + (1 - m) * c
        h = m * (o * np.tanh(new)) + (1 - m) * h
        out[t] = h
    return out, h, c


def _run(x, mask, wx, wh, b):
    """States of one direction over a padded batch (time, page, value); a masked step keeps the state."""
    steps, pages, _ = x.shape
    h = c = np.zeros((pages, HIDDEN), np.float32)
    kept, states = [], np.zeros((steps, pages, HIDDEN), np.float32)
    inputs = x @ wx + b
    for t in range(steps):
        gates = inputs[t] + h @ wh
        i, f, o = (sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        before_h, before_c = h, c
        new = f * c + i * g
        c = m * new + (1 - m) * c
        h = m * (o * np.tanh(new)) + (1 - m) * h
        kept.append((i, f, o, g, new, before_h, before_c, m))
        states[t] = h
    return states, kept


def _back(x, slopes, kept, wh):
    """Gradients of one direction, from the slopes of its states."""
    d_inputs = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    dh = dc = np.zeros_like(slopes[0])
    for t in range(len(kept) - 1, -1, -1):
        i, f, o, g, new, before_h, before_c, m = kept[t]
        dh = dh + slopes[t]
        squashed = np.tanh(new)
        d_new = m * (dc + dh * o * (1 - squashed**2))
        gates = np.concatenate([
            d_new * g * i * (1 - i), d_new * before_c * f * (1 - f), m * dh * squashed * o * (1 - o), d_new * i * (1 - g**2),
        ], axis=1)
        d_inputs[t] = gates
        d_wh += before_h.T @ gates
        dc = d_new * f + (1 - m) * dc
        dh = gates @ wh.T + (1 - m) * dh
    return [np.tensordot(x, d_inputs, ([0, 1], [0, 1])), d_wh, d_inputs.sum((0, 1))]


def _padded(rows: list[np.ndarray]):
    steps = max(map(len, rows))
    x = np.zeros((steps, len(rows), PATH + WORDS + FIGURES), np.float32)
    mask = np.zeros((steps, len(rows)), np.float32)
    for k, row in enumerate(rows):
        x[:len(row), k], mask[:len(row), k] = row, 1
    return x, mask


@dataclass
class Network:
    values: list[np.ndarray]  # forward wx, wh, b; backward wx, wh, b; output weights and constant; weights of the block itself

    @classmethod
    def fresh(cls):
        random = np.random.default_rng(3)
        draw = lambda *shape: (random.normal(0, 0.1, shape)).astype(np.float32)
        one = lambda: [draw(PATH + WORDS + FIGURES, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32)]
        return cls([*one(), *one(), draw(2 * HIDDEN), np.zeros(1, np.float32), np.zeros(PATH + WORDS + FIGURES, np.float32)])

    def states(self, x, mask):
        there, kept = _run(x, mask, *self.values[:3])
        back, kept_back = _run(x[::-1], mask[::-1], *self.values[3:6])
        return np.concatenate([there, back[::-1]], axis=2), kept, kept_back

    def _output(self, states, x):
        return states @ self.values[6] + self.values[7][0] + x @ self.values[8]

    def slopes(self, x, mask, y):
        states, kept, kept_back = self.states(x, mask)
        pull = mask * (sigmoid(self._output(states, x)) - y) / mask.sum()
        d_states = pull[..., None] * self.values[6]
        return [
            *_back(x, d_states[..., :HIDDEN], kept, self.values[1]),
            *_back(x[::-1], d_states[::-1, :, HIDDEN:], kept_back, self.values[4]),
            np.tensordot(states, pull, ([0, 1], [0, 1])), np.array([pull.sum()], np.float32), np.tensordot(x, pull, ([0, 1], [0, 1])),
        ]

    def logits(self, pages: list[list]) -> np.ndarray:
        """Of all blocks (block, page). At most ``CELLS`` blocks stand in vectors at once, of a long page too."""
        wx, wh, b, wx_back, wh_back, b_back, out, constant, own = self.values
        weights = np.concatenate([wx, wx_back, own[:, None]], axis=1)
        lengths = np.array([len(blocks) for blocks in pages])
        steps, span = lengths.max(), max(1, CELLS // len(pages))
        lows = list(range(0, steps, span))

        def read(low):
            high = min(low + span, steps)
            values = np.zeros((high - low, len(pages), weights.shape[1]), np.float32)
            for k, blocks in enumerate(pages):
                part = _projected(blocks, low, high, weights)
                values[:len(part), k] = part
            return values, (np.arange(low, high)[:, None] < lengths).astype(np.float32)

        logits, gates = np.full((steps, len(pages)), constant[0], np.float32), 4 * HIDDEN
        h = c = np.zeros((len(pages), HIDDEN), np.float32)
        for low in lows:
            values, mask = read(low)
            states, h, c = _states(values[..., :gates] + b, mask, wh, h, c)
            logits[low:low + span] += states @ out[:HIDDEN] + values[..., -1]
        h = c = np.zeros((len(pages), HIDDEN), np.float32)
        for low in reversed(lows):
            if len(lows) > 1:
                values, mask = read(low)
            states, h, c = _states(values[::-1, :, gates:2 * gates] + b_back, mask[::-1], wh_back, h, c)
            logits[low:low + span] += states[::-1] @ out[HIDDEN:]
        return logits

    def labels(self, pages: list[list]) -> list[np.ndarray]:
        """Which blocks are article. Pages of like length are read together, a long page alone."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        group: list[int] = []
        for k, following in zip(order, [*order[1:], None]):
            group.append(k)
            if following is None or len(group) == 64 or (len(group) + 1) * len(pages[following]) > CELLS:
                marked = self.logits([pages[own] for own in group]) > 0
                for n, own in enumerate(group):
                    found[own] = marked[:len(pages[own]), n]
                group = []
        return found


def is_text(path: tuple[str, ...]) -> bool:
    """Whether the markup itself calls a block article text."""
    names = {w for token in path if token[0] == "." for w in (token[1:], *token[1:].replace("_", "-").split("-"))}
    return any(t in path for t in ("article", "main")) and not names & set(FURNITURE_NAMES) and not set(path) & set(FURNITURE_TAGS)


def _nested(random):
    """Up to six divisions, most with a name that tells nothing."""
    names = [NEUTRAL[random.integers(len(NEUTRAL))] if random.random() < 0.5 else f"x{random.integers(10**6)}" for _ in range(random.integers(7))]
    return tuple(token for name in names for token in (("div", "." + name) if random.random() < 0.8 else ("div",)))


def _altered(blocks, random):
    """A stretch of a page with other furniture, labelled."""
    plain = random.random() < 0.25
    renamed = (("div", "." + str(random.choice(["content", "post", "entry", "story", "text"]))) if random.random() < 0.7 else ("main",)) if plain else ("article",)
    deep = random.random() < 0.5
    chain = lambda: _nested(random) if deep else ()
    above, below = chain(), chain()
    out = []
    start = random.integers(max(1, len(blocks) - STRETCH))
    for path, text, linked in blocks[start:start + STRETCH]:
        label = is_text(path)
        path = tuple(t for token in path for t in ((*above, *renamed, *below) if token == "article" else (token,)))
        if label and random.random() < 0.15:  # other leaves of an article
            path = (*path[:-1], *[("blockquote", "p"), ("ul", "li"), ("section", "p"), ("h2",), ("table", "tr", "td"), ("pre",), ("figure", "figcaption"), ("div", "p")][random.integers(8)])
        out.append((path, text, linked, label))
    for _ in range(random.integers(1, 5)):  # a run of furniture blocks, anywhere
        name = FURNITURE_NAMES[random.integers(len(FURNITURE_NAMES))]
        tag = FURNITURE_TAGS[random.integers(len(FURNITURE_TAGS))]
        box = [("div", "." + name), (tag,), ("section", "." + name), (tag, "." + name), ("ul", "." + name)][random.integers(5)]
        inside = ("html", "body", *((*above, *renamed, *below) if random.random() < 0.5 else chain()))
        box = (*box, *chain())
        at = random.integers(len(out) + 1)
        for _ in range(random.integers(1, 5)):
            words = out[random.integers(len(out))][1].split() if out else ["more"]
            text = " ".join(words[:random.integers(1, 40)]) or "more"
            leaf = ((LEAVES[random.integers(len(LEAVES))],) if random.random() < 0.7 else ())
            out.insert(at, ((*inside, *box, *leaf), text, float(random.random() < 0.3), False))
    return out


MADE = "<html><head><title>One two</title></head><body><nav><ul><li><a href=x>One</a></li></ul></nav><article><h1>One two</h1><p>Three four five.</p><p>Six seven eight nine.</p></article><footer>Ten</footer></body></html>"


def _learned(head: str, random) -> list:
    """The blocks of a page to learn from: a bounded stretch of a long one."""
    blocks = blocks_of(head if len(head) < HEAD_CHARS else head.rpartition("<")[0])
    start = random.integers(max(1, len(blocks) - LEARNED + 1))
    return blocks[start:start + LEARNED]


def train(pages: list[str]) -> Network:
    """A network fitted with Adam to the pages and their altered copies."""
    random = np.random.default_rng(11)
    read = [blocks for html in [*pages, *[MADE] * 20] if (blocks := _learned(html, random))]
    rows = [(blocks, [is_text(path) for path, _, _ in blocks]) for blocks in read]
    for blocks in read:
        for _ in range(COPIES):
            made = _altered(blocks, random)
            rows.append(([b[:3] for b in made], [b[3] for b in made]))
    rows.sort(key=lambda row: len(row[0]))  # batches of like length
    batches = []
    for at in range(0, len(rows), BATCH):
        own = rows[at:at + BATCH]
        y = np.zeros((max(len(blocks) for blocks, _ in own), len(own)), np.float32)
        for k, (_, label) in enumerate(own):
            y[:len(label), k] = label
        batches.append(([blocks for blocks, _ in own], y))
    network = Network.fresh()
    first, second = [np.zeros_like(v) for v in network.values], [np.zeros_like(v) for v in network.values]
    step = 0
    for epoch in range(EPOCHS):
        for k in random.permutation(len(batches)):
            step += 1
            blocks, y = batches[k]  # the vectors of all would not be small
            x, mask = _padded([vectors(page) for page in blocks])
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for v, m, s, g in zip(network.values, first, second, network.slopes(x, mask, y)):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return network


def _extracted(network):
    def run(batches):
        for batch in batches:
            pages = [blocks_of(h) if h else [] for h in batch.column("_html").to_pylist()]
            texts = ["\n".join(text for (_, text, _), keep in zip(blocks, marked) if keep) for blocks, marked in zip(pages, network.value.labels(pages))]
            columns = [pa.array(texts, pa.string()) if c == "_html" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=["_text" if c == "_html" else c for c in batch.schema.names])

    return run


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` but the html, and ``text``: the article's blocks, a line each."""
    spark = ready(pages.sparkSession)
    heads = pages.select(F.substring(html_col, 1, HEAD_CHARS).alias("html")).where(F.length("html") > 0)
    sample = heads.orderBy(F.xxhash64("html"), "html").limit(PAGES)
    network = spark.sparkContext.broadcast(train([row["html"] for row in sample.collect()]))
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(F.col(html_col).alias("_html"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)])
    schema = ", ".join(f"{'_text' if c == '_html' else c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(_extracted(network), schema).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], F.col("_text").alias("text"))
