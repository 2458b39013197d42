"""Main-text extraction from HTML by tag-path ratios."""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>|</?[a-zA-Z][^<>]*\Z|[^<]+|<", re.S)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
LABEL = re.compile(r"""\s(?:id|class)\s*=\s*["']?\s*([^\s"'>]+)""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟।]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select
    summary table tbody td tfoot th thead tr ul""".split())
#: Elements that hold no article text.
DROPPED = frozenset("""aside audio button canvas datalist dialog footer form head iframe input label map menu nav noembed noframes
    noscript object option script select style svg template textarea title video""".split())
#: Words of a class or id, or a role, that mark what isn't the article.
NOISE = frozenset("""ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs byline comment
    commentlist comments complementary consent contentinfo cookie cookies copyright dialog discussion disqus donate feedback
    footer form gdpr hidden legal login masthead menu menubar modal nav navbar navigation newsletter notice notices
    notification outbrain overlay pager pagination paywall popup promo promoted promotion reactions recommended register
    related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    taboola teaser toast toolbar topbar tooltip tracking widget widgets""".split())
#: These mark noise outside an article only: an article's own header holds its title.
OUTER_NOISE = frozenset(["header"])
CONTAINERS = frozenset(["article", "main"])
UNMARKED = frozenset(["html", "body", "article", "main"])
#: A start tag closes these open elements.
CLOSES = {t: frozenset(["p"]) for t in BLOCK if t not in ("html", "body", "option")} | {
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"])}
#: An implied end tag isn't looked for outside these.
SCOPES = frozenset("html body article main section div ul ol dl table td th blockquote aside nav header footer form".split())


def _is_noise(tag: str, text: str, in_container: bool) -> bool:
    if tag in DROPPED or tag in OUTER_NOISE and not in_container:
        return True
    if tag in UNMARKED or " " not in text and "\n" not in text and "\t" not in text:
        return False
    for name, a, b, c in ATTRIBUTE.findall(text[len(tag) + 1 : -1]):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id", "role"):
            words = set(re.split(r"[^a-z]+", value))
            if words & NOISE or not in_container and words & OUTER_NOISE:
                return True
    return False


def text_nodes(page: str) -> list[tuple[str, int, str, str]]:
    """(tag path, block number, container path, raw text) of every text outside dropped elements, in page order.

    A path's steps are tags, with the first id or class of a marked one, so that sibling sections have paths of
    their own."""
    out, stack, steps, noise_at, block = [], [], [], [], 0  # noise_at: depths at which dropped elements are open
    container: list[int] = []
    pos, low = 0, None
    while m := TOKEN.match(page, pos):
        pos, token = m.end(), m.group()
        if token[0] != "<" or len(token) == 1:
            if not noise_at:
                inside = "/".join(steps[: container[-1]]) if container else ""
                out.append(("/".join(steps), block, inside, token))
            continue
        name = TAG.match(token)
        if not name:
            continue
        tag = name[1].lower()
        if token[1] == "/":
            if tag in stack:
                while stack:
                    done = stack.pop()
                    steps.pop()
                    block += done in BLOCK
                    if done == tag:
                        break
            elif tag in BLOCK:
                block += 1
        else:
            closes = CLOSES.get(tag, ())
            k = len(stack)
            while closes and k and (stack[k - 1] in closes or stack[k - 1] not in SCOPES):
                k -= 1
                if stack[k] in closes:
                    del stack[k:], steps[k:]
            while noise_at and noise_at[-1] > len(stack):
                noise_at.pop()
            while container and container[-1] > len(stack):
                container.pop()
            block += tag in BLOCK
            if tag == "br" and not noise_at and out:
                out.append((out[-1][0], block, out[-1][2], " "))
            if tag not in VOID:
                noisy = not noise_at and _is_noise(tag, token, bool(container))
                if tag in RAW:
                    low = low or page.lower()
                    end = low.find("</" + tag, pos) if len(low) == len(page) else -1
                    if end < 0 and (found := re.compile("</" + tag, re.I).search(page, pos)):
                        end = found.start()
                    pos = len(page) if end < 0 else end
                stack.append(tag)
                label = LABEL.search(token) if tag not in UNMARKED else None
                steps.append(f"{tag}.{label[1]}" if label else tag)
                if noisy:
                    noise_at.append(len(stack))
                elif tag in CONTAINERS:
                    container.append(len(stack))
        while noise_at and noise_at[-1] > len(stack):
            noise_at.pop()
        while container and container[-1] > len(stack):
            container.pop()
    return out


def _smoothed(values: list[float], radius: int = 1) -> list[float]:
    """Gaussian-weighted mean of each value and its neighbours."""
    weight = [math.exp(-(d * d) / 2) for d in range(radius + 1)]
    out = []
    for i in range(len(values)):
        total = norm = 0.0
        for j in range(max(0, i - radius), min(len(values), i + radius + 1)):
            w = weight[abs(i - j)]
            total += w * values[j]
            norm += w
        out.append(total / norm)
    return out


def extract(page: str | None, share: float = 0.5) -> str:
    """The main text of a page: blocks joined by one newline.

    Text length and punctuation are summed for each root-to-leaf tag path and
    divided by the path's number of text nodes; both ratios are smoothed over
    the page's node order and fused as a geometric mean; a path is content if
    its mean reaches ``share`` standard deviations (the best path always
    is).  Paths fuse with a content path of the same parent, or of the same
    article or main element, so an article's heading and short paragraphs stay.
    Null and empty pages give an empty text."""
    nodes = [(p, b, c, entities.unescape(t)) for p, b, c, t in text_nodes(page or "")]
    full = [(p, b, c, t) for p, b, c, t in nodes if t.strip()]
    if not full:
        return ""
    if any(c for _, _, c, _ in full):
        full = [x for x in full if x[2]]
    chars, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for p, _, _, t in full:
        chars[p] += len(" ".join(t.split()))
        marks[p] += len(PUNCTUATION.findall(t))
        count[p] += 1
    length = _smoothed([chars[p] / count[p] for p, _, _, _ in full])
    points = _smoothed([(1 + marks[p]) / count[p] for p, _, _, _ in full])
    fused = [math.sqrt(a * b) for a, b in zip(length, points, strict=True)]
    by_path = defaultdict(float)
    for (p, _, _, _), f in zip(full, fused, strict=True):
        by_path[p] += f / count[p]
    mean = sum(fused) / len(fused)
    limit = min(share * math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused)), max(by_path.values()))
    content = {p for p in by_path if by_path[p] >= limit}
    inside = {c for p, _, c, _ in full if c and p in content}
    parents = {p.rpartition("/")[0] for p in content}
    keep = {p for p, _, c, _ in full if p in content or c in inside or p.rpartition("/")[0] in parents}
    blocks: dict[int, list[str]] = {}
    for p, b, _, t in nodes:
        if p in keep:
            blocks.setdefault(b, []).append(t)
    lines = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    Whole pages are parsed, whatever their length; null or empty html, and
    pages without text, give an empty text.  Repeated rows give equal rows,
    other columns are ignored.  Rows are independent: no shuffle, and a task
    holds one Arrow batch."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                texts = [extract(x) for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return df.select(id_col, url_col, html_col).mapInArrow(
        run, f"page_id {id_type}, url string, text string, n_chars long")
