"""Main text of web pages by nearest-URL page differencing.

A page's markup becomes lines, one per block.  Pages are sorted by host and URL
path over range partitions (a host may fill many of them); a page is paired with
the ``REACH`` nearest pages of other content before and after it on its host
(pages of equal lines are folded), the lines are aligned by a longest common
subsequence, and shared lines are deleted as template.  Pages whose neighbours
may lie in another partition go, with the pages next to them, through a small
second pass by host, so texts do not depend on the partitions.

What the markup says outright is kept to: scripts, styles, forms, menus, headers,
footers, sidebars, notices, adverts and reader comments never count as text.
The differencing decides about all other lines.  A neighbour that shares most of
the text of the longer of both pages may be a near copy: alone it deletes nothing,
but what ``SEVERAL`` different pages share is template.  Article markup is evidence
for a line: it goes only if all neighbours share it, and ``SEVERAL`` that are no near
copies (with ``SEVERAL`` alone, passages that stories repeat would go).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import land, table

# --- fixed values: HTML element names and usual class names ---
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
UNREAD = set("audio button canvas datalist embed frameset head iframe math noframes noscript object script select style svg template textarea title video".split())
BOILER = set("aside dialog footer form menu nav".split())
BOILER_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
BOILER_NAMES = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead"
    " menu modal nav navbar navigation newsletter notice pagination popup promo promoted related respond responses share sharing sidebar social sponsor"
    " sponsored subscribe toolbar widget".split()
)
NAME_ENDS = set(  # what follows the word in the name of a page part
    "area bar block box button buttons center column container content copy cta dialog feed form group header icon icons inner item items label left links list"
    " main menu message notice overlay panel post posts prompt right row section signup slot stories thread title top unit widget widgets wrap wrapper zone".split()
)
NAME_NEGATIONS = set("disable enable from has have hide layout no non not show supports with without".split())
OWN_END = {"li": {"ul", "ol", "menu"}, "p": set(), "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# --- end of fixed values ---

ARTICLE, OPEN, DROPPED = 2, 1, 0  # what the markup says about a line
SAME_SHARE = 0.6
REACH, SEVERAL = 3, 3  # neighbours on each side; so many pages of other content make a template
TAIL = re.compile(r"<[A-Za-z/!?][^<>]*$")  # a tag cut off by the page's end
SPACE = re.compile(r"\s+")
PARTS = re.compile(r"[a-z]+|[0-9]+")


def names_boiler(names: str) -> bool:
    """Whether a class or id attribute names a page part that is never article text.

    The whole name counts, not any part of it: ``footer``, ``site-footer``, ``share-buttons`` and ``ad-2``
    do, ``has-sidebar``, ``no-comments`` and ``share-price`` do not.
    """
    for name in names.lower().split():
        parts = [x for x in PARTS.findall(name) if not x.isdigit()]
        if not parts or NAME_NEGATIONS.intersection(parts[:-1]):
            continue
        while len(parts) > 1 and parts[-1] in NAME_ENDS and parts[-1] not in BOILER_NAMES:
            parts.pop()
        if parts[-1] in BOILER_NAMES:
            return True
    return False


class Lines(HTMLParser):
    """Collects ``(text, kind)`` lines of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []
        self.lines: list[tuple[str, int]] = []
        self.parts: list[str] = []
        self.state = OPEN

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        self.parts.clear()
        if text:
            self.lines.append((text, self.state))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in BLOCKS:
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        if tag in OWN_END:
            self.close_open(tag)
        before = self.state
        self.state = self.kind(tag, attrs)
        self.stack.append((tag, before))

    def kind(self, tag, attrs) -> int:
        if self.state == DROPPED or tag in UNREAD or tag in BOILER:
            return DROPPED
        named = {k: (v or "").lower() for k, v in attrs}
        hidden = "hidden" in named or named.get("aria-hidden") == "true"
        if hidden or named.get("role") in BOILER_ROLES or tag not in ("html", "body", "article", "main") and names_boiler(named.get("class", "") + " " + named.get("id", "")):
            return DROPPED
        if tag == "header":
            return self.state if self.state == ARTICLE else DROPPED
        return ARTICLE if tag in ("article", "main") or named.get("role") in ("article", "main") else self.state

    def close_open(self, tag):
        """A new item ends an open one of its kind in the same list."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                self.flush()
                self.state = self.stack[i][1]
                del self.stack[i:]
                return
            if name in OWN_END[tag] or tag == "p" and name in BLOCKS:
                return

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if any(name in BLOCKS for name, _ in self.stack[i:]):
                    self.flush()
                self.state = self.stack[i][1]
                del self.stack[i:]
                return
        if tag in BLOCKS:
            self.flush()

    def handle_data(self, data):
        if self.state != DROPPED:
            self.parts.append(data)


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Readable lines with their kind; null gives none."""
    parser = Lines()
    parser.feed(TAIL.sub("", html or ""))
    parser.close()
    parser.flush()
    return parser.lines


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]  # bit j clear: the match length grows at column j
    for line in x:
        v = rows[-1]
        u = v & where.get(line, 0)
        rows.append((v + u | v - u) & full)
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i -= 1
            j -= 1
            found.add(head + i)
    return found


def main_text(page: list[tuple[str, int]], neighbours: list[list[tuple[str, int]]]) -> str:
    """The page's lines less its template: lines shared with a neighbour, inside an article with all and ``SEVERAL``."""
    texts = [t for t, _ in page]
    own, length = set(texts), sum(map(len, texts))
    by_page, by_copy = [0] * len(page), [0] * len(page)  # neighbours that share each line
    for near in neighbours:
        other = [t for t, _ in near]
        if own.isdisjoint(other):
            continue
        shared = common_lines(texts, other)
        copy = sum(len(texts[i]) for i in shared) > SAME_SHARE * max(length, sum(map(len, other)))
        for i in shared:
            (by_copy if copy else by_page)[i] += 1
    inside = [n >= SEVERAL and n + m == len(neighbours) for n, m in zip(by_page, by_copy)]
    outside = [by_page[i] > 0 or by_copy[i] >= SEVERAL for i in range(len(page))]
    return "\n".join(t for i, (t, kind) in enumerate(page) if not (inside[i] if kind == ARTICLE else outside[i]))


class Page:
    """A page's content, the rows that have it, and its nearest pages of other content by digest."""

    def __init__(self, seq: int, lines: list[tuple[str, int]], digest: bytes, members: list[tuple], before: dict[bytes, Page]):
        self.seq, self.lines, self.digest, self.members = seq, lines, digest, members
        self.before, self.after = before, {}

    def text(self) -> str:
        """Asked once: the neighbours are let go, or each page would hold all before it."""
        near = [p.lines for p in self.take().values()]
        return main_text(self.lines, near)

    def take(self) -> dict[bytes, Page]:
        near = {**self.before, **self.after}
        self.before, self.after = {}, {}
        return near


class Host:
    """The pages of one host in URL order; what it gives out has found its neighbours, as far as there are any."""

    def __init__(self):
        self.recent: dict[bytes, Page] = {}  # the last contents, latest last
        self.first: dict[bytes, Page] = {}
        self.pending: dict[bytes, Page] = {}  # without all neighbours behind it: at most REACH + 1

    def add(self, seq: int, lines: list[tuple[str, int]], digest: bytes, members: list[tuple]) -> list[Page]:
        others = [d for d in self.recent if d != digest]
        now = Page(seq, lines, digest, members, {d: self.recent[d] for d in others[-REACH:]})
        for p in self.pending.values():
            if p.digest != digest and len(p.after) < REACH:
                p.after.setdefault(digest, now)
        if digest in self.pending:
            self.pending[digest].members.extend(members)
            now.before = {}
        else:
            self.pending[digest] = now
        self.recent.pop(digest, None)
        self.recent[digest] = now
        if len(self.recent) > REACH + 1:
            del self.recent[next(iter(self.recent))]
        if len(self.first) <= REACH:
            self.first.setdefault(digest, now)
        done = [p for p in self.pending.values() if len(p.after) == REACH]
        for p in done:
            del self.pending[p.digest]
        return done


def packed(lines: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """Digest and compressed bytes of a page's lines; no line holds a line end."""
    data = "\n".join(f"{kind}{t}" for t, kind in lines).encode("utf-8", "surrogatepass")
    size = len(data).to_bytes(8, "little")
    return hashlib.blake2b(data, digest_size=16).digest(), size + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(value: bytes) -> list[tuple[str, int]]:
    data = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    return [(x[1:], int(x[0])) for x in data.decode("utf-8", "surrogatepass").split("\n") if x]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` of every row of ``pages``.

    Null, empty or text-free html gives ''.  A null URL is a host and path of its
    own.  Repeated rows stay, each with its text.  Other columns are
    ignored; an empty table gives no rows.
    """
    where = F.regexp_extract(F.coalesce(F.lower(url_col), F.lit("")), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*|[?#].*$", "")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), where.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [packed(page_lines(html.as_py())) for html in b["html"]]
            yield pa.RecordBatch.from_arrays(
                [*(b[c] for c in ("page_id", "url", "host", "path")), *(pa.array([x[k] for x in got], pa.binary()) for k in (0, 1))],
                ["page_id", "url", "host", "path", "digest", "lines"],
            )

    # Only a page's packed lines are shuffled; the markup is parsed again for the sample that sets the ranges.
    rows = rows.mapInArrow(parse, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, path string, digest binary, lines binary")
    spread = ["host", "path", "url", "page_id", "digest"]
    rows = rows.repartitionByRange(*spread).sortWithinPartitions(*spread).select("page_id", "url", "host", "digest", "lines")
    member = f"struct<page_id:{kinds['page_id']},url:{kinds['url']}>"
    # Rows of finished pages have no part; the others hold the content of an edge page and its members.
    schema = f"text string, host string, part int, seq long, digest binary, lines binary, members array<{member}>"

    def batch(finished: list[tuple], edges: list[tuple], member_type) -> pa.RecordBatch:
        kind = pa.schema([
            ("text", pa.string()), ("host", pa.string()), ("part", pa.int32()), ("seq", pa.int64()),
            ("digest", pa.binary()), ("lines", pa.binary()), ("members", pa.list_(member_type)),
        ])
        got = [(text, None, None, None, None, None, members) for text, members in finished] + [(None, *e) for e in edges]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), kind)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, name, host, inner, kind = TaskContext.get().partitionId(), 0, None, Host(), False, None
        out: list[tuple] = []
        edge: dict[int, Page] = {}  # what the second pass needs of the present host, and whose texts it is to give
        unsettled: set[int] = set()

        def give(pages: list[Page], ended: bool) -> None:
            for p in pages:
                if (inner or len(p.before) == REACH) and (ended or len(p.after) == REACH):
                    out.append((p.text(), p.members))
                else:
                    edge.update({x.seq: x for x in (*p.before.values(), *p.after.values(), p)})
                    unsettled.add(p.seq)
                    p.take()

        def close(ended: bool) -> list[tuple]:
            """The edge rows of the host."""
            give(list(host.pending.values()), ended)
            if not inner:
                edge.update({x.seq: x for x in host.first.values()})
            if not ended:
                edge.update({x.seq: x for x in host.recent.values()})
            rows = [
                (name, part, p.seq, *packed(p.lines), p.members if at in unsettled else [])
                for at, p in edge.items()
            ]
            edge.clear(), unsettled.clear()
            return rows

        for b in batches:
            kind = kind or pa.struct([("page_id", b["page_id"].type), ("url", b["url"].type)])
            for page_id, url, at, digest, lines in zip(b["page_id"], b["url"], b["host"], b["digest"], b["lines"]):
                at = at.as_py()
                if at != name:
                    if name is not None:
                        rest = close(True)
                        if rest:
                            yield batch([], rest, kind)
                        inner = True
                    name, host = at, Host()
                give(host.add(seq, unpacked(lines.as_py()), digest.as_py(), [(page_id.as_py(), url.as_py())]), False)
                seq += 1
                if len(out) >= 1024:
                    yield batch(out, [], kind)
                    out.clear()
        if name is not None:
            last = close(False)
            if out or last:
                yield batch(out, last, kind)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, host, kind = None, Host(), None
        out: list[tuple] = []
        for b in batches:
            kind = kind or b["members"].type.value_type
            for r in b.to_pylist():
                if r["host"] != name:
                    out += [(p.text(), p.members) for p in host.pending.values()]
                    name, host = r["host"], Host()
                members = [(m["page_id"], m["url"]) for m in r["members"]]
                out += [(p.text(), p.members) for p in host.add(r["seq"], unpacked(r["lines"]), r["digest"], members)]
                if len(out) >= 1024:
                    yield batch(out, [], kind)
                    out.clear()
        out += [(p.text(), p.members) for p in host.pending.values()]
        if out:
            yield batch(out, [], kind)

    once = land(rows.mapInArrow(run, schema), "pages", "zstd")
    edges = once.where(F.col("part").isNotNull()).repartition("host").sortWithinPartitions("host", "part", "seq")
    texts = once.where(F.col("part").isNull()).unionByName(edges.mapInArrow(rest, schema))
    return texts.select(F.explode("members").alias("m"), "text").select("m.page_id", "m.url", "text")


def op3(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op3_html_extraction``."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
