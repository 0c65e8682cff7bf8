"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks: runs of text between block-level tags,
with the path of open elements above them.  Each block becomes a vector: the
embeddings of its hashed path tokens (tags, pairs of tags, the words and
letter groups of class, id and role), the mean embedding of its hashed words,
and a few measures (length, share of link text, punctuation, place in the
page).  A bidirectional LSTM in numpy runs over all blocks of the page, so that
every block is classified with the whole document as context; blocks labelled
as main text are joined in page order.

Training.  Pages carry no labels.  A bounded sample of pages (``SAMPLE`` pages
of at most ``SAMPLE_BYTES``, chosen by a hash of their html) teaches by its own
semantic elements: what stands in article or main, outside of nav, aside,
footer, header and form, is main text.  Their texts also fill ``DRAWN`` training
pages drawn from a grammar of page layouts (menus, headers, notices, adverts,
sidebars, forms, reader comments and footers, in plain and in semantic markup,
around and inside the article), so that the labeller does not depend on one
site's markup.  Seeds are fixed: reruns agree.

Defined cases: a null or empty html gives an empty text; markup may be broken
anywhere: an unclosed comment, script or tag runs to the end of the page,
stray end tags and lone "<" are ignored or text; a page without a block of
main text gives an empty text; pages may be of any length (the labeller walks
over all blocks, never a prefix); rows with null or repeated page_id or url are
scored one by one like any other; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, span_hash, word_spans

SAMPLE, SAMPLE_BYTES, DRAWN = 400, 1 << 16, 1600
PATH_SLOTS, WORD_SLOTS, WIDE, HIDDEN = 4096, 8192, 16, 24
GROUP_BYTES = 2 << 20        # html worked off together
NUMBERS = 8

# ------------------------------------------------------------------ parsing
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>"
    r"|<[!?/][^>]*+>|<[a-zA-Z!?/][^>]*+\Z", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())       # run to the end if not closed
UNSEEN = frozenset("noscript template svg select button datalist object audio video canvas".split())
SCOPE = frozenset("html table td th caption".split())
# A start tag closes open elements of these names, up to the bounds.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW | UNSEEN}


class Leaf:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path, text, linked):
        self.path, self.text, self.linked = path, text, linked


def leaves(html: str | None) -> list[Leaf]:
    """The text blocks of a page in order: path of (tag, attributes), text
    with white space collapsed, characters inside links."""
    html = html or ""
    out, stack, parts, opened = [], [], [], {}
    path, linked, missing, pos = None, 0, set(), 0

    def flush():
        nonlocal path, linked
        if path is not None:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Leaf(path, text, linked))
        parts.clear()
        path, linked = None, 0

    def close(k):
        for tag, _ in stack[k:]:
            opened[tag] -= 1
        del stack[k:]

    def find(names, bounds):
        if any(opened.get(n) for n in names):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in names:
                    return k
                if stack[k][0] in bounds:
                    return None
        return None

    while pos < len(html):
        m = TOKEN.search(html, pos)
        stop = m.start() if m else len(html)
        if stop > pos:
            text = unescape(html[pos:stop])
            if path is None and not text.isspace():
                path = tuple(stack) if len(stack) <= 24 else (*stack[:6], *stack[-18:])
            parts.append(text)
            if opened.get("a"):
                linked += len(text)
        if not m:
            break
        pos = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag in BLOCK:
                flush()
                k = find({tag}, SCOPE - {tag})
            else:
                k = find({tag}, BLOCK)
            if k is not None:
                close(k)
        elif tag in RAW or tag in UNSEEN and tag not in missing:
            end = _END[tag].search(html, pos)
            if end:
                pos = end.end()
            elif tag in RAW:
                break
            else:
                missing.add(tag)
        elif tag == "br":
            parts.append(" ")
        elif tag not in VOID or tag == "hr":
            if tag in BLOCK:
                flush()
                k = find({"p"}, SCOPE)
                if k is not None:
                    close(k)
                if tag in CLOSES:
                    names, bounds = CLOSES[tag]
                    lowest = None
                    while (k := find(names, bounds)) is not None:
                        lowest = k
                        close(k)
            if tag != "hr":
                stack.append((tag, m["attrs"]))
                opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


# ----------------------------------------------------------------- features
ATTRIBUTE = re.compile(r"(class|id|role|aria-label|itemprop|rel|type)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def path_slots(path: tuple) -> np.ndarray:
    """Hashed tokens of a path of (tag, attributes)."""
    tokens, above = [], "^"
    for k, (tag, attrs) in enumerate(path):
        tokens += [f"t {tag}", f"p {above} {tag}"]
        if k == len(path) - 1:
            tokens.append(f"l {tag}")
        above = tag
        for name, *value in ATTRIBUTE.findall(attrs):
            for part in PART.findall(" ".join(value)):
                part = part.lower()
                tokens.append(f"c {part}")
                tokens += [f"g {part[i:i + 4]}" for i in range(max(len(part) - 3, 1))]
    return np.array(sorted({zlib.crc32(t.encode()) % PATH_SLOTS for t in tokens}), np.int64)


class Blocks:
    """The leaves of some pages as arrays: path index, words, measures."""

    def __init__(self, pages: list[list[Leaf]], cache: dict):
        flat = [leaf for page in pages for leaf in page]
        self.count = np.array([len(p) for p in pages], np.int64)
        paths, local = [], {}
        for leaf in flat:
            if leaf.path not in local:
                if leaf.path not in cache:
                    if len(cache) > 20_000:
                        cache.clear()
                    cache[leaf.path] = path_slots(leaf.path)
                local[leaf.path] = len(paths)
                paths.append(cache[leaf.path])
        self.paths = paths
        self.path_of = np.array([local[leaf.path] for leaf in flat], np.int64)
        texts = [leaf.text.encode("utf-8", "surrogatepass") for leaf in flat]
        buf = np.frombuffer(b" ".join(texts).translate(LOWER), np.uint8)
        starts, ends = word_spans(buf)
        self.words = (span_hash(buf, starts, ends) % np.uint64(WORD_SLOTS)).astype(np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size + 1) - size - 1
        self.word_at = np.searchsorted(starts, begin)                       # each leaf has at least one word
        n_words = np.diff(np.append(self.word_at, len(starts)))
        marks = np.concatenate([[0], np.cumsum(np.isin(buf, np.frombuffer(b".,;:!?", np.uint8)))])
        digits = np.concatenate([[0], np.cumsum((buf >= 48) & (buf <= 57))])
        chars = np.array([len(leaf.text) for leaf in flat], np.float64)
        linked = np.array([leaf.linked for leaf in flat], np.float64)
        first = np.repeat(np.cumsum(self.count) - self.count, self.count)
        page = np.repeat(self.count, self.count)
        place = np.arange(len(flat)) - first
        self.numbers = np.stack([
            np.log1p(n_words) / 3, np.minimum(linked / np.maximum(chars, 1), 1), 10 * (marks[begin + size] - marks[begin]) / np.maximum(size, 1),
            4 * (digits[begin + size] - digits[begin]) / np.maximum(size, 1), (chars / n_words) / 8, place / np.maximum(page - 1, 1),
            np.exp(-place / 4.0), np.exp(-(page - 1 - place) / 4.0)], axis=1).astype(np.float32) if flat else np.zeros((0, NUMBERS), np.float32)


# ------------------------------------------------------------------- model
def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def reverse(count: np.ndarray, steps: int) -> np.ndarray:
    """For each step and page the step it mirrors within the page's length."""
    t = np.arange(steps)[:, None]
    return np.where(t < count, count - 1 - t, t)


class Labeller:
    """Embeddings, an LSTM in each direction, and a logistic layer."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        d, h = 2 * WIDE + NUMBERS, HIDDEN

        def init(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"path": init(PATH_SLOTS, WIDE, scale=0.3), "word": init(WORD_SLOTS, WIDE, scale=0.3)}
        for way in "fb":
            self.p["x" + way], self.p["h" + way] = init(d, 4 * h, scale=d ** -0.5), init(h, 4 * h, scale=h ** -0.5)
            self.p["c" + way] = np.repeat(np.float32([0, 1, 0, 0]), h)       # forget gates begin open
        self.p["out"], self.p["bias"] = init(2 * h + d, scale=0.1), np.zeros(1, np.float32)

    def inputs(self, b: Blocks) -> np.ndarray:
        per_path = np.array([self.p["path"][s].sum(axis=0) / np.sqrt(len(s) + 1) for s in b.paths], np.float32).reshape(-1, WIDE)
        n = np.diff(np.append(b.word_at, len(b.words)))[:, None]
        words = np.add.reduceat(self.p["word"][b.words], b.word_at, axis=0) / n if len(b.words) else np.zeros((0, WIDE))
        return np.concatenate([per_path[b.path_of], words, b.numbers], axis=1).astype(np.float32)

    def _walk(self, x, way, keep):
        """x (steps, pages, d) -> states (steps, pages, h); gates if kept."""
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c, wh = np.zeros_like(h), self.p["h" + way]
        states, kept = np.empty((*x.shape[:2], HIDDEN), np.float32), []
        for t in range(len(x)):
            g = x[t] @ self.p["x" + way] + h @ wh + self.p["c" + way]
            i, f, o = (sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            before, last = c, h
            c = f * c + i * u
            y = np.tanh(c)
            h = o * y
            states[t] = h
            if keep:
                kept.append((i, f, o, u, before, y, last))
        return states, kept

    def forward(self, x, count, keep=False):
        """Logits (steps, pages) of padded inputs (steps, pages, d)."""
        turn, cols = reverse(count, len(x)), np.arange(x.shape[1])
        back = x[turn, cols]
        hf, kf = self._walk(x, "f", keep)
        hb, kb = self._walk(back, "b", keep)
        z = np.concatenate([hf, hb[turn, cols], x], axis=2)
        return z @ self.p["out"] + self.p["bias"][0], (x, back, z, kf, kb, turn, cols)

    def _back(self, dh, x, way, kept, grad):
        """Gradient of the states (steps, pages, h) -> gradient of x."""
        dx = np.empty_like(x)
        h_next, c_next = (np.zeros(dh.shape[1:], np.float32) for _ in range(2))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, u, before, y, last = kept[t]
            d = dh[t] + h_next
            dc = d * o * (1 - y * y) + c_next
            g = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), d * y * o * (1 - o), dc * i * (1 - u * u)], axis=1)
            c_next = dc * f
            grad["x" + way] += x[t].T @ g
            grad["h" + way] += last.T @ g
            grad["c" + way] += g.sum(axis=0)
            h_next, dx[t] = g @ self.p["h" + way].T, g @ self.p["x" + way].T
        return dx

    def gradient(self, b: Blocks, y: np.ndarray) -> tuple[float, dict]:
        flat, where = self.inputs(b), padded(b.count)
        x = np.where((where >= 0)[..., None], flat[np.maximum(where, 0)], 0).astype(np.float32)
        logit, (x, back, z, kf, kb, turn, cols) = self.forward(x, b.count, keep=True)
        real = where >= 0
        target = np.where(real, y[np.maximum(where, 0)], 0)
        # Pages count alike, whatever their number of blocks.
        weight = np.where(real, 1 / np.maximum(b.count, 1), 0) / len(b.count)
        prob = sigmoid(logit)
        loss = float(-(weight * np.log(np.where(target > 0, prob, 1 - prob) + 1e-9)).sum())
        d = ((prob - target) * weight).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"], grad["bias"] = np.einsum("tb,tbk->k", d, z), d.sum().reshape(1)
        dz = d[..., None] * self.p["out"]
        dx = dz[..., 2 * HIDDEN:] + self._back(dz[..., :HIDDEN], x, "f", kf, grad)
        dx += self._back(dz[..., HIDDEN:2 * HIDDEN][turn, cols], back, "b", kb, grad)[turn, cols]
        dflat = np.zeros_like(flat)
        dflat[where[real]] = dx[real]
        per_path = np.zeros((len(b.paths), WIDE), np.float32)
        np.add.at(per_path, b.path_of, dflat[:, :WIDE])
        for s, g in zip(b.paths, per_path, strict=True):
            grad["path"][s] += g / np.sqrt(len(s) + 1)
        n = np.diff(np.append(b.word_at, len(b.words)))
        np.add.at(grad["word"], b.words, np.repeat(dflat[:, WIDE:2 * WIDE] / n[:, None], n, axis=0))
        return loss, grad

    def fit(self, pages: list[tuple[list[Leaf], np.ndarray]], rounds: int = 3, batch: int = 32, rate: float = 0.01) -> "Labeller":
        pages = [p for p in pages if p[0]]
        rng, cache, step = np.random.default_rng(5), {}, 0
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for turn in range(rounds):
            # Pages of like length share a batch; batches come in random order.
            size = np.array([len(p[0]) for p in pages]) * rng.uniform(0.7, 1.4, len(pages))
            order = np.argsort(size, kind="stable")
            for at in rng.permutation(range(0, len(order), batch)):
                part = [pages[i] for i in order[at:at + batch]]
                _, grad = self.gradient(Blocks([p for p, _ in part], cache), np.concatenate([y for _, y in part]))
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= rate * 0.5 ** turn * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
        return self

    def label(self, pages: list[list[Leaf]], cache: dict) -> list[np.ndarray]:
        """Probability of main text for every leaf of every page."""
        b = Blocks(pages, cache)
        flat, out = self.inputs(b), np.zeros(int(b.count.sum()), np.float32)
        start, order = np.cumsum(b.count) - b.count, np.argsort(b.count, kind="stable")
        order = order[b.count[order] > 0]
        at = 0
        while at < len(order):
            # Pages of like length walk together.
            most = b.count[order[at]] * 1.3 + 4
            stop = min(at + 256, int(np.searchsorted(b.count[order], most, side="right")))
            part = order[at:stop]
            t = np.arange(b.count[part].max())[:, None]
            where = np.where(t < b.count[part], start[part] + t, -1)
            x = np.where((where >= 0)[..., None], flat[np.maximum(where, 0)], 0)
            out[where[where >= 0]] = sigmoid(self.forward(x, b.count[part])[0])[where >= 0]
            at = stop
        return np.split(out, np.cumsum(b.count)[:-1])


def padded(count: np.ndarray) -> np.ndarray:
    """Index of the leaf at (step, page), -1 beyond the page's end."""
    t = np.arange(count.max(initial=0))[:, None]
    return np.where(t < count, np.cumsum(count) - count + t, -1)


# ---------------------------------------------------------------- training
OUTSIDE = frozenset("nav aside footer header form".split())


def taught(page: list[Leaf]) -> np.ndarray | None:
    """Labels by the page's own semantic elements, None without any."""
    names = [[tag for tag, _ in leaf.path] for leaf in page]
    if not any("article" in n or "main" in n for n in names):
        return None
    y = []
    for leaf, n in zip(page, names, strict=True):
        top = max((k for k, t in enumerate(n) if t in ("article", "main")), default=None)
        # An article inside a comment section is none; a heading may stand in the article's own header.
        inner = [] if top is None else n[top + 1:]
        fine = top is not None and not set(inner) & (OUTSIDE - {"header"}) and not set(n[:top]) & {"nav", "aside", "footer"}
        fine &= "header" not in inner or any(t in ("h1", "h2") for t in inner)
        y.append(fine)
    return np.array(y, np.float32)


# Usual names and phrases of page parts, for the training pages.
MAIN_NAMES = ("content main-content post post-content entry-content article-body story-body body-copy page-content text article "
              "blog-post news-text rich-text prose markdown-body single-post").split()
NAMES = {
    "menu": "nav navbar menu main-menu navigation topnav site-nav breadcrumb breadcrumbs pagination pager tabs toc-links links skip-link".split(),
    "header": "header site-header masthead topbar page-header branding logo site-title tagline hero-banner top".split(),
    "notice": "notice cookie cookie-banner cookie-notice consent gdpr alert alert-info banner popup modal overlay paywall privacy-notice "
              "announcement message disclaimer newsletter-popup warning toast info-bar".split(),
    "advert": "ad ads advert advertisement adsbox ad-slot banner-ad sponsored sponsor promo promotion promoted commercial google-ad "
              "dfp outbrain taboola offer".split(),
    "sidebar": "sidebar side widget widgets related related-posts recommended most-read trending popular tags tag-cloud archive recent "
               "right-column left-column rail teaser more-stories share social social-share follow author-box".split(),
    "form": "form search search-form login signup subscribe newsletter contact-form feedback poll".split(),
    "comment": "comment comments comment-list commentlist comment-body user-comments discussion responses reply replies disqus "
               "reader-comments respond thread reactions guestbook reviews".split(),
    "footer": "footer site-footer page-footer copyright legal colophon bottom imprint foot sitemap".split(),
}
TAGS = {"menu": "nav nav div ul", "header": "header header div", "notice": "div div section aside p", "advert": "div div aside ins section",
        "sidebar": "aside aside div section", "form": "form form div", "comment": "section div ol div", "footer": "footer footer div"}
PHRASES = {
    "menu": "Home|About us|Contact|News|Products|Login|Sign in|Next|Previous|Accueil|Startseite|Inicio|Kontakt|Archive|Blog|Help|Skip to content",
    "header": "Welcome|The daily site|Your source for news|Menu|Search|Subscribe|Today|Sign in",
    "notice": "We use cookies to improve your experience.|Accept all cookies|This site uses cookies. By continuing you agree.|Please enable "
              "JavaScript.|You have 2 free articles left.|Wir verwenden Cookies.|Ce site utilise des cookies.|Este sitio usa cookies.|"
              "Read our privacy policy.|Your browser is out of date.|Breaking news alert|Scheduled maintenance tonight.",
    "advert": "Advertisement|Sponsored|Buy now and save 50%!|Limited offer, order today.|Anzeige|Publicité|Publicidad|Click here|Free shipping|"
              "Promoted content|Special offer for you",
    "sidebar": "Related articles|Most read|You may also like|Share this|Follow us|Tags|Recent posts|Popular|Categories|Read more|Share on social media",
    "form": "Your e-mail address|Subscribe to our newsletter|Sign up|Search|Submit|Send|Name|Password|Log in|Remember me|I agree to the terms",
    "comment": "Comments|Leave a reply|Reply|3 comments|Great post, thanks for sharing!|I do not agree with this.|Posted by guest at 10:32|"
               "Report|Like|Anonymous says:|Log in to comment|Thanks, very helpful.|First!",
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|Imprint|Contact us|© Example Ltd.|Powered by|Impressum|"
              "Mentions légales|Back to top|Copyright",
}


class Layouts:
    """Draws pages whose parts are known.  ``y="1"`` and ``y="0"`` on an
    element mark its blocks; path tokens never read that attribute."""

    def __init__(self, main: list[str], other: list[str], seed: int = 23):
        self.rng = random.Random(seed)
        words = "one two three four five six seven eight nine ten".split()
        self.main = main or [" ".join(self.rng.choices(words, k=self.rng.randint(4, 60))) + "." for _ in range(200)]
        self.other = other or self.main

    def name(self, kind: str) -> str:
        """An attribute that names the part, mostly; else one that does not."""
        r = self.rng
        x = r.random()
        if x < 0.12:
            return ""
        word = r.choice(NAMES[kind] if kind != "main" else MAIN_NAMES)
        if x < 0.3:
            word = r.choice(["site", "page", "block", "box", "js", "l", "the"]) + r.choice("-_") + word
        elif x < 0.4:
            word += r.choice(["-1", "-wrapper", "-inner", "Area", "box", "-container", "_item", "Section"])
        return f' {r.choice(["class", "class", "class", "id"])}="{word}"'

    def text(self, kind: str) -> str:
        r = self.rng
        x = r.random()
        if x < 0.45:
            return r.choice(PHRASES[kind].split("|"))
        words = r.choice(self.other if x < 0.7 else self.main).split()
        n = r.randint(1, 4) if kind in ("menu", "header") else r.randint(2, 40)
        at = r.randrange(max(1, len(words) - n))
        words = words[at:at + n]
        if kind == "footer" and r.random() < 0.5:
            words.insert(0, "©")
        return " ".join(words) or "x"

    def aside(self, kind: str) -> str:
        """A part that is not main text."""
        r = self.rng
        tag = r.choice(TAGS[kind].split())
        named = self.name(kind)
        if not named and tag in ("div", "section", "ul", "p", "ol"):
            named = f' class="{r.choice(NAMES[kind])}"'
        n = r.randint(1, 8) if kind in ("menu", "sidebar", "comment") else r.randint(1, 3)
        link = r.random() < {"menu": 0.95, "sidebar": 0.6, "footer": 0.5}.get(kind, 0.15)
        items = [f'<a href="#">{self.text(kind)}</a>' if link else self.text(kind) for _ in range(n)]
        if kind == "comment":
            way = r.random()
            each = r.choice(["<div{n}>{t}</div>", "<li{n}><p>{t}</p></li>", "<article{n}><p>{t}</p></article>", "<p>{t}</p>", "<div{n}><b>user</b><p>{t}</p></div>"])
            body = "".join(each.format(n=' class="comment"' if way < 0.8 else "", t=t) for t in items)
            body = (r.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<p>{}</p>"]).format(self.text(kind)) if r.random() < 0.6 else "") + body
        elif tag == "ul" or kind in ("menu", "sidebar") and r.random() < 0.6:
            body = "".join(f"<li>{t}</li>" for t in items)
            body = body if tag == "ul" else f"<ul>{body}</ul>"
        elif kind == "form":
            body = "".join(f"<label>{t}</label><input>" for t in items) if r.random() < 0.5 else "".join(f"<p>{t}</p>" for t in items)
        elif tag == "p" or r.random() < 0.4:
            body = " ".join(items)
        else:
            body = "".join(r.choice(["<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<span>{}</span> ", "<h3>{}</h3>"]).format(t) for t in items)
        return f'<{tag}{named} y="0">{body}</{tag}>'

    def block(self) -> str:
        r = self.rng
        x, t = r.random(), r.choice(self.main)
        if x < 0.72:
            return f"<p>{t}</p>" if r.random() < 0.8 else f"<p><b>{t}<br>"
        if x < 0.8:
            return f"<{(h := r.choice(['h2', 'h3']))}>{' '.join(t.split()[:6])}</{h}>"
        if x < 0.86:
            lines = "".join(f"<li>{' '.join(r.choice(self.main).split()[:r.randint(1, 12)])}</li>" for _ in range(r.randint(2, 5)))
            return f"<ul>{lines}</ul>" if r.random() < 0.7 else f"<ol>{lines}</ol>"
        if x < 0.9:
            return f"<blockquote>{t}</blockquote>" if r.random() < 0.5 else f"<blockquote><p>{t}</p></blockquote>"
        if x < 0.93:
            return "<table>" + "".join(f"<tr><td>{' '.join(t.split()[:3])}</td><td>{' '.join(t.split()[3:6])}</td></tr>" for _ in range(2)) + "</table>"
        if x < 0.96:
            return f"<figure><img><figcaption>{' '.join(t.split()[:10])}</figcaption></figure>" if r.random() < 0.5 else f"<pre><code>{t}</code></pre>"
        return f"<div>{t}</div>" if r.random() < 0.6 else f'<p>{t} <a href="#">{" ".join(t.split()[:3])}</a></p>'

    def page(self) -> str:
        r = self.rng
        inner = [self.block() for _ in range(r.randint(1, 14) if r.random() < 0.9 else r.randint(15, 60))]
        for _ in range(r.choice([0, 0, 1, 2])):
            inner.insert(r.randint(0, len(inner)), self.aside(r.choice(["advert", "advert", "sidebar", "form", "notice"])))
        if r.random() < 0.12:
            inner.append(self.aside("comment"))
        if r.random() < 0.75:
            title = f"<h1>{' '.join(r.choice(self.main).split()[:10])}</h1>"
            inner.insert(0, f"<header>{title}</header>" if r.random() < 0.15 else title)
        shape = r.choice(["article", "article", "main", "main", "both", "named", "named", "named", "bare", "cell"])
        body = "".join(inner)
        named = self.name("main") if r.random() < 0.5 else ""
        body = {"article": f'<article{named} y="1">{body}</article>', "main": f'<main{named} y="1">{body}</main>',
                "both": f'<main><article{named} y="1">{body}</article></main>',
                "named": f'<{(t := r.choice(["div", "div", "section"]))} {r.choice(["class", "id"])}="{r.choice(MAIN_NAMES)}" y="1">{body}</{t}>',
                "bare": f'<div y="1">{body}</div>', "cell": f'<table><tr><td y="1">{body}</td></tr></table>'}[shape]
        before = [self.aside(k) for k in ("notice", "header", "menu", "advert", "form", "sidebar") if r.random() < 0.45]
        after = [self.aside(k) for k in ("sidebar", "comment", "form", "advert", "notice", "sidebar", "footer") if r.random() < 0.45]
        r.shuffle(before)
        if shape == "main" and after and r.random() < 0.2:        # a comment section inside main, after the article
            body = body.replace("</main>", after.pop(0) + "</main>")
        if r.random() < 0.5:
            body = f"<div{r.choice(['', ' class=wrapper', ' id=page', ' class=container'])}>{body}</div>"
        return "<html><body>" + "".join(before) + body + "".join(after) + "</body></html>"

    def example(self) -> tuple[list[Leaf], np.ndarray]:
        page = leaves(self.page())
        y = [next((m[1] == "1" for _, a in reversed(leaf.path) if (m := re.search(r' y="([01])"', a))), False) for leaf in page]
        for leaf in page:
            leaf.path = tuple((tag, re.sub(r' y="[01]"', "", a)) for tag, a in leaf.path)
        return page, np.array(y, np.float32)


def train(pages: DataFrame) -> Labeller:
    """Fit on a sample bounded by ``SAMPLE`` pages of ``SAMPLE_BYTES``; a page
    that is repeated counts once."""
    small = pages.where(F.octet_length("html").between(1, SAMPLE_BYTES)).select(F.xxhash64("html").alias("h"), "html")
    n = small.count()
    # The threshold leaves about twice the sample, whatever the number of pages and partitions.
    share = min(1.0, 2 * SAMPLE / max(n, 1))
    part = small.where(F.col("h") <= min(int(-2**63 + share * 2**64), 2**63 - 1)).groupBy("h").agg(F.min("html").alias("html"))
    found = sorted(part.orderBy("h").limit(SAMPLE).collect(), key=lambda r: r.h)
    sample = [leaves(r.html) for r in found]
    real = [(p, y) for p in sample if (y := taught(p)) is not None]
    main = [leaf.text for p, y in real for leaf, k in zip(p, y, strict=True) if k and len(leaf.text) < 4000]
    other = [leaf.text for p, y in real for leaf, k in zip(p, y, strict=True) if not k and len(leaf.text) < 400]
    draw = Layouts(main, other)
    return Labeller().fit(real + [draw.example() for _ in range(DRAWN)])


# ------------------------------------------------------------------ extract
def texts(model: Labeller, htmls: list, cache: dict) -> list[str]:
    pages = [leaves(h) for h in htmls]
    labels = model.label(pages, cache) if any(pages) else [()] * len(pages)
    return [" ".join(leaf.text for leaf, p in zip(page, y, strict=True) if p >= 0.5) for page, y in zip(pages, labels, strict=True)]


def _extract(model: Labeller):
    def run(batches):
        cache = {}
        for batch in batches:
            html = batch.column(batch.num_columns - 1)
            size = pa.compute.fill_null(pa.compute.binary_length(html), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(size) // GROUP_BYTES
            cuts = np.flatnonzero(np.diff(group, prepend=-1))
            for i, j in zip(cuts, np.append(cuts[1:], len(size)), strict=True):
                part = batch.slice(i, j - i)
                found = [t.encode("utf-8", "replace").decode() for t in texts(model, html.slice(i, j - i).to_pylist(), cache)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or train(pages)
    types = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        _extract(model), f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
