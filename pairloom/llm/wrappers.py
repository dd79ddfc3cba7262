"""Main text of HTML pages by wrappers: union-free regular expressions over page structure.

The pages of a host come from few templates. A page is read leniently into a tree; runs of
equal siblings fold into one repeated group. Aligning the tree of one page with
the wrapper so far gives the next wrapper: where children differ, what only one side has
becomes optional; what either side repeats stays repeated; texts that differ become a
slot, equal ones stay fixed. Elements align by tag and by those of their class, id and role tokens
that a tenth of the host's pages share, so a wrapper is bound by its templates, not by its pages.
Wrappers align with wrappers the same way, so each task infers one per host over all distinct
pages it reads, and these are aligned per host and group of tasks, then per host.

Each page is then mapped onto its host's wrapper, which decides what is kept. The main text
lies in the page's articles, else its main element, else in the deepest of the page's groups that
holds most of the text outside links, by the mean of the host's pages that have the group. There,
slots and repeats are kept. Blocks that are fixed in the wrapper are dropped if at least FIXED_PAGES
distinct pages and half of those with the main part have them while the rest changes. Parts that are menus,
headers, footers, sidebars, notices, adverts, forms or comments by their element or name are left out.
A name counts if one of its tokens consists of listed words only; names and forms are overruled
where the group holds most of the text outside links of the pages that have it, and never
count for html, body, main and article.

Defined results: null and empty html give an empty text; a page whose url has no host is
of the host ''; unclosed elements end with their parent; text after an unclosed script or
comment is part of it.
"""

import collections
import functools
import hashlib
import html as html_lib
import json
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.host_filter import host_and_path
from pairloom.session import materialize

# Wrappers up to this size together are broadcast; larger sets meet in an equi join.
BROADCAST_BYTES = 8 << 20
# Distinct pages that must agree before a text counts as fixed. It must also be in at least half of
# the pages that have the main part, and the rest must hold this share of the main part's text.
FIXED_PAGES = 5
CHANGING_SHARE = 0.2
# A name is part of alignment keys if one of so many pages of the host has it.
STABLE_PAGES = 10
# Cells of an alignment table; longer lists are folded to one group per key first.
TABLE_CELLS = 1 << 16
# Wrappers of a host are merged in so many groups of tasks, then once more.
SALTS = 32
# Longer fixed texts are held by their digest.
LONG_TEXT = 80

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
KNOWN = VOID | RAW | BLOCKS | frozenset(
    " a abbr b bdi bdo big body button center cite code data datalist del dfn em fieldset font frame frameset hgroup "
    "html i ins kbd label legend map mark math meter nobr object optgroup option output picture progress q rp rt "
    "ruby s samp search select slot small span strike strong sub summary sup time title tt u var video audio".split(" "))
# An opening element ends an open one of these that lies nearer than the element's scope.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select".split())
BLOCK = BLOCKS - {"p"}
LEFT_OUT = frozenset("aside button dialog footer head header input menu nav select title".split())
# These may hold the article, whatever their names say.
NEVER_BY_NAME = frozenset(["", "html", "body", "main", "article"])
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "consent contentinfo complementary cookie cookies disqus footer form header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())

_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TAGS = re.compile(r"<([A-Za-z][^\s/>]*)")
_PLAIN = re.compile(r"[a-z][a-z-]*")
_DIGIT = re.compile(r"\d")
_TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)")


class Element:
    __slots__ = ("tag", "names", "children")

    def __init__(self, tag, names=""):
        self.tag, self.names, self.children = tag, names, []


class Keys(dict):
    """Alignment keys by tag and names: of the names only stable ones, and ! for candidates to leave out."""

    def __init__(self, stable):
        self.stable = frozenset(stable)

    def __missing__(self, tag_names):
        tag, names = tag_names
        stable = sorted(self.stable.intersection(names.split()))
        key = tag if tag in KNOWN or f"<{tag}" in self.stable else "?"
        if stable:
            key += "." + " ".join(stable)
        if _named_left_out(tag, names):
            key += "!"
        if len(self) >= 10_000:
            self.clear()
        self[tag_names] = key
        return key


def _page_names(page):
    """Names of a page that may be stable: tokens without digits, and unusual tags."""
    names = {f"<{tag}" for tag in map(str.lower, _TAGS.findall(page)) if tag not in KNOWN and _PLAIN.fullmatch(tag)}
    if "=" in page:
        for found in _NAMED.findall(page):
            names.update(next(filter(None, found[1:]), "").split())
    return [name for name in names if not _DIGIT.search(name)]


def _is_stable(n, pages):
    """Whether enough of a host's pages have a name; for numbers and for columns."""
    return (n * STABLE_PAGES >= pages) & ((n >= 2) | (pages == 1))


@functools.lru_cache(maxsize=10_000)
def _named_left_out(tag, names):
    """Whether an element is a candidate by name: a whole token consists of listed words only."""
    if tag in NEVER_BY_NAME:
        return False
    return tag == "form" or any(
        LEFT_OUT_NAMES.issuperset(token.split("-")) for token in names.lower().replace("_", "-").split())


def _key_tag(key):
    return key.rstrip("!").split(".")[0]


def _is_left_out(key, text, page_text):
    """A name or a form says nothing where a group holds most of its pages' text outside links."""
    return _key_tag(key) in LEFT_OUT or key.endswith("!") and 2 * text <= page_text


def _tag_end(page, start):
    """Place after the tag that begins at `start`; quotes may hold `>`."""
    end = page.find(">", start)
    quote = None
    at = start
    while end >= 0:
        for c in page[at:end]:
            if quote is None and c in "\"'":
                quote = c
            elif c == quote:
                quote = None
        # A quote that never ends is no quote.
        if quote is None or page.find(quote, end) < 0:
            return end + 1
        at, end = end, page.find(">", end + 1)
    return -1


def read(page: str) -> Element:
    """The page as a tree; texts are str children with references decoded."""
    root = Element("")
    stack = [root]
    at = 0

    def text(raw):
        if raw:
            stack[-1].children.append(html_lib.unescape(raw))

    # Places on the stack by tag and by class, so that closing costs what it closes, at any depth.
    places = {BLOCK: [], SCOPE: []}

    def kinds(tag):
        yield tag
        if tag in BLOCK:
            yield BLOCK
        if tag in SCOPE:
            yield SCOPE

    def push(element):
        for kind in kinds(element.tag):
            places.setdefault(kind, []).append(len(stack))
        stack.append(element)

    def close(tags, fence=None):
        """Close the nearest of the tags unless it lies outside the nearest fence."""
        place = max((places[tag][-1] for tag in tags if places.get(tag)), default=0)
        if place and (fence is None or not places[fence] or places[fence][-1] < place):
            for element in stack[place:]:
                for kind in kinds(element.tag):
                    places[kind].pop()
            del stack[place:]

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        if page.startswith("<!--", start):
            text(page[at:start])
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            text(page[at:start])
            end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        match = _TAG.match(page, start + 1)
        if not match:
            text(page[at : start + 1])
            at = start + 1
            continue
        text(page[at:start])
        end = _tag_end(page, match.end())
        if end < 0:
            break
        closing, tag = match[1], match[2].lower()
        attributes = page[match.end() : end - 1]
        at = end
        if closing:
            close((tag,), SCOPE if tag in ENDS else None)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                done = _raw_end(tag).search(page, end)
                at = done.end() if done else len(page)
            continue
        if tag in BLOCKS:
            close(("p",), BLOCK)
        if tag in ENDS:
            close(ENDS[tag], SCOPE)
        names = ""
        if attributes and "=" in attributes:
            found = [next(filter(None, m[1:]), "") for m in _NAMED.findall(attributes)]
            names = " ".join(" ".join(found).split())
        element = Element(tag, names)
        stack[-1].children.append(element)
        if tag not in VOID and not attributes.endswith("/"):
            push(element)
    return root


@functools.lru_cache(maxsize=64)
def _raw_end(tag):
    return re.compile(rf"</{tag}\b[^>]*>", re.I)


# A wrapper node is a dict: key, pages (that have it), repeat, text (fixed text, or None for
# a slot), same (digest of all that a page has in the group, None where pages differ), words and
# linked (characters outside and inside links), total (characters outside links of the pages
# that have it), children. Long fixed texts are held by their digest.


def _digest(*parts) -> str:
    return hashlib.blake2b(repr(parts).encode("utf-8", "surrogatepass"), digest_size=9).hexdigest()


def _align(a, b):
    """Align two folded sequences of bundles (key, *lists); uses up both."""
    if not a or not b:
        return a or b
    if len(a) * len(b) > TABLE_CELLS:
        a, b = _by_key(a), _by_key(b)
    if len(a) == len(b) and all(x[0] == y[0] for x, y in zip(a, b)):
        return [_join(x, y) for x, y in zip(a, b)]
    out, i, j = [], 0, 0
    for i2, j2 in [*_matches([x[0] for x in a], [y[0] for y in b]), (len(a), len(b))]:
        out += a[i:i2]
        out += b[j:j2]
        if i2 < len(a):
            out.append(_join(a[i2], b[j2]))
        i, j = i2 + 1, j2 + 1
    return _folded(out)


def _folded(bundles):
    """Neighbours with one key become one bundle."""
    out = []
    for bundle in bundles:
        if out and out[-1][0] == bundle[0]:
            _join(out[-1], bundle)
        else:
            out.append(bundle)
    return out


def _by_key(bundles):
    """One bundle per key, in the order of first places."""
    held = {}
    for bundle in bundles:
        if bundle[0] in held:
            _join(held[bundle[0]], bundle)
        else:
            held[bundle[0]] = bundle
    return list(held.values())


def _join(bundle, other):
    for held, more in zip(bundle[1:], other[1:]):
        held += more
    return bundle


def _matches(a, b):
    """Pairs of places of a longest common subsequence."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    n, m = len(a) - low, len(b) - low
    while n and m and a[low + n - 1] == b[low + m - 1]:
        n, m = n - 1, m - 1
    out = [(i, i) for i in range(low)]
    length = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            if a[low + i] == b[low + j]:
                length[i][j] = length[i + 1][j + 1] + 1
            else:
                length[i][j] = max(length[i + 1][j], length[i][j + 1])
    i = j = 0
    while i < n and j < m:
        if a[low + i] == b[low + j]:
            out.append((low + i, low + j))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            i += 1
        else:
            j += 1
    rest = len(a) - low - n
    return out + [(low + n + k, low + m + k) for k in range(rest)]


def _node(root: Element, keys: Keys) -> dict:
    """The wrapper of one page; its groups know their elements."""
    def group(key, elements, linked):
        return {"key": key, "pages": 1, "repeat": len(elements) > 1, "linked_to": linked or elements[0].tag == "a",
                "elements": elements}

    top = group("", [root], False)
    nodes = [top]
    for node in nodes:  # grows while read
        texts, bundles = [], None
        for element in node["elements"]:
            children, own = [], []
            for child in element.children:
                if isinstance(child, str):
                    own.append(child)
                else:
                    children.append((keys[child.tag, child.names], [child]))
            texts.append(" ".join(" ".join(own).split()) if own else "")
            children = _folded(children)
            bundles = children if bundles is None else _align(bundles, children)
        size = sum(map(len, texts))
        node["words"], node["linked"] = (0, size) if node["linked_to"] else (size, 0)
        text = texts[0] if all(t == texts[0] for t in texts) else None
        node["text"] = text if text is None or len(text) <= LONG_TEXT else _digest(text)
        node["same"] = texts
        node["children"] = [group(key, elements, node["linked_to"]) for key, elements in bundles]
        nodes += node["children"]
    for node in reversed(nodes):
        inner = node["children"]
        node["same"] = _digest(node["key"], node["same"], [c["same"] for c in inner])
        node["raw"] = node["words"] + sum(c["raw"] for c in inner if c["elements"][0].tag not in LEFT_OUT)
    for node in nodes:
        node["total"] = top["raw"]
    return top


def _aligned(a: dict, b: dict) -> dict:
    """The least wrapper that fits what either of two with one key fits."""
    def merged(key, ours, theirs):
        nodes = ours + theirs
        if len(nodes) == 1:
            return nodes[0]
        once = len(ours) <= 1 and len(theirs) <= 1
        first = nodes[0]
        node = {
            "key": key,
            # What was folded may be on the same pages.
            "pages": max((n["pages"] for n in ours), default=0) + max((n["pages"] for n in theirs), default=0),
            "total": max((n["total"] for n in ours), default=0) + max((n["total"] for n in theirs), default=0),
            "repeat": not once or any(n["repeat"] for n in nodes),
            "text": first["text"] if all(n["text"] == first["text"] for n in nodes) else None,
            "same": first["same"] if once and all(n["same"] == first["same"] for n in nodes) else None,
            "words": sum(n["words"] for n in nodes), "linked": sum(n["linked"] for n in nodes),
        }
        open_nodes.append((node, ours, theirs))
        return node

    open_nodes = []
    top = merged(a["key"], [a], [b])
    for node, ours, theirs in open_nodes:  # grows while read
        sides = [[(c["key"], [c], []) for c in n["children"]] for n in ours]
        sides += [[(c["key"], [], [c]) for c in n["children"]] for n in theirs]
        node["children"] = [merged(*bundle) for bundle in functools.reduce(_align, sides)]
    return top


def infer(pages) -> dict:
    """The wrapper of some pages; copies count once."""
    pages = list(dict.fromkeys(pages))
    counts = collections.Counter(name for page in pages for name in _page_names(page))
    stable = sorted(name for name, n in counts.items() if _is_stable(n, len(pages)))
    keys = Keys(stable)
    return functools.reduce(_aligned, (_node(read(p), keys) for p in pages)) | {"stable": stable}


def expression(wrapper: dict) -> str:
    """The wrapper as a regular expression over elements: ( )? optional, ( )+ repeated, # a slot."""
    out, todo = [], [(wrapper, wrapper["pages"])]
    while todo:
        node, parent_pages = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        mark = ("+" if node["repeat"] else "") + ("?" if node["pages"] < parent_pages else "")
        out.append(("(" if mark else "") + f"<{node['key']}>" + ("#" if node["text"] is None else node["text"]))
        todo.append((f"){mark}" if mark else "", 0))
        todo += [(c, node["pages"]) for c in reversed(node["children"])]
    return "".join(out)


FIELDS = ("key", "pages", "total", "repeat", "text", "same", "words", "linked")


def _rows(wrapper: dict) -> list:
    """A wrapper as rows of depth and fields, parents first; nesting has no limit."""
    out, todo = [], [(0, wrapper)]
    while todo:
        depth, node = todo.pop()
        out.append([depth, *(node[f] for f in FIELDS)])
        todo += [(depth + 1, c) for c in reversed(node["children"])]
    return out


def _from_rows(rows) -> dict:
    path = []
    for depth, *values in rows:
        node = dict(zip(FIELDS, values), children=[])
        del path[depth:]
        if path:
            path[-1]["children"].append(node)
        path.append(node)
    return path[0]


def main_part(wrapper: dict) -> dict:
    """What pages need of the wrapper: per group its depth, key, pages, repeat, sizes and fixed contents."""
    out, todo = [], [(0, wrapper)]
    while todo:
        depth, node = todo.pop()
        out.append([depth, node["key"], node["pages"], int(node["repeat"]), node["words"],
                    node["same"], node["words"] + node["linked"], node["total"]])
        todo += [(depth + 1, c) for c in reversed(node["children"])]
    return {"stable": wrapper["stable"], "groups": out}


class Group:
    """A group of a wrapper, as pages are mapped onto it."""

    __slots__ = ("key", "tag", "pages", "repeat", "mass", "raw", "fixed", "size", "total", "left_out", "children",
                 "keys", "_dropped")

    def __init__(self, key, pages, repeat, words, fixed, size, total):
        self.key, self.pages, self.repeat, self.fixed, self.size, self.total = key, pages, repeat, fixed, size, total
        self.tag = _key_tag(key)
        self.mass = self.raw = words
        self.children, self._dropped = [], None

    def dropped(self):
        """The fixed groups below, as far as they are boilerplate where this is the main part."""
        if self._dropped is None:
            found, todo = [], list(self.children)
            while todo:
                group = todo.pop()
                if group.left_out:
                    continue
                if (group.fixed and group.size and group.tag in BLOCKS and group.pages >= FIXED_PAGES
                        and 2 * group.pages >= self.pages):
                    found.append(group)
                else:
                    todo += group.children
            # Where hardly anything else changes, the pages are near copies and not of one template.
            changing = self.size - sum(group.size for group in found)
            self._dropped = frozenset(found if changing >= CHANGING_SHARE * self.size else [])
        return self._dropped


def _groups(part: dict) -> Group:
    path, all_groups = [], []
    for depth, *values in part["groups"]:
        group = Group(*values)
        del path[depth:]
        if path:
            path[-1].children.append(group)
        path.append(group)
        all_groups.append(group)
    # Children come after their parents, so they are complete first.
    for group in reversed(all_groups):
        for child in group.children:
            group.raw += 0 if child.tag in LEFT_OUT else child.raw
            group.size += child.size
            group.mass += 0 if child.left_out else child.mass
        group.left_out = _is_left_out(group.key, group.raw, group.total)
    all_groups[0].keys = Keys(part["stable"])
    return all_groups[0]


def _map_page(page: dict, wrapper: Group) -> None:
    """Give each group of a page its group of the wrapper, or None where alignment found none."""
    todo = [(page, wrapper)]
    while todo:
        node, group = todo.pop()
        node["group"] = group
        children = group.children if group else []
        met = {}
        if len(node["children"]) * len(children) <= TABLE_CELLS:
            met = dict(_matches([c["key"] for c in node["children"]], [g.key for g in children]))
        first = {g.key: g for g in reversed(children)}
        for i, child in enumerate(node["children"]):
            todo.append((child, children[met[i]] if i in met else first.get(child["key"])))


def _left_out(node):
    """Whether a group of a page is left out; what met no group of the wrapper goes by its own page."""
    return node["group"].left_out if node["group"] else _is_left_out(node["key"], node["raw"], node["total"])


def _main_nodes(page: dict):
    """The groups of a page that hold its main text: articles, else main elements, else the deepest
    group with most of the text outside links. Mass is the mean of the host's pages that have the group."""
    def mean(node):
        if _left_out(node):
            return 0
        return node["group"].mass / node["group"].pages if node["group"] else node["raw"]

    found, todo = {"article": [], "main": []}, [(page, frozenset())]
    while todo:
        node, inside = todo.pop()
        if _left_out(node):
            continue
        tag = node["elements"][0].tag
        if tag in found and tag not in inside:
            found[tag].append(node)
            inside |= {tag}
        todo += [(c, inside) for c in node["children"]]
    for nodes in found.values():
        if nodes:
            return nodes
    node = page
    while True:
        inner = max(node["children"], key=mean, default=None)
        # The last group that is no single block of text but holds most of it.
        if inner is None or inner["repeat"] or (inner["group"] and inner["group"].repeat) or (
                not inner["children"] or 10 * mean(inner) < 6 * mean(node)):
            return [node]
        node = inner


def extract(page: str, part: dict) -> str:
    """Blocks of the main part in page order, one per line."""
    return _extracted(page, _groups(part))


def _extracted(page: str, wrapper: Group) -> str:
    root = read(page)
    top = _node(root, wrapper.keys)
    _map_page(top, wrapper)
    main = {id(node): node["group"].dropped() if node["group"] else frozenset() for node in _main_nodes(top)}
    node_of, nodes = {}, [top]
    for node in nodes:  # grows while read
        node_of.update((id(element), node) for element in node["elements"])
        nodes += node["children"]
    blocks, words = [], []

    def end_block():
        line = " ".join("".join(words).split())
        if line:
            blocks.append(line)
        words.clear()

    # None ends a block. `dropped` is None outside the main part.
    todo = [(root, None)]
    while todo:
        item, dropped = todo.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            words.append(item)
        elif item.tag == "br":
            words.append(" ")
        elif not _left_out(node := node_of[id(item)]):
            start = dropped is None and id(node) in main
            if start:
                dropped = main[id(node)]
            elif dropped and node["group"] in dropped and node["same"] == node["group"].fixed:
                end_block()
                continue
            if start or item.tag in BLOCKS:
                end_block()
                todo.append((None, None))
            todo += [(c, dropped) for c in reversed(item.children) if dropped is not None or not isinstance(c, str)]
    end_block()
    return "\n".join(blocks)


def _local_names(batches):
    """Pages of a host that a task reads, as name '', and how many of them have a name."""
    counts = collections.Counter()

    def rows():
        hosts, names = zip(*counts)
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(names, pa.string()),
                                           pa.array(counts.values(), pa.int64())], names=["host", "name", "n"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[host, ""] += 1
            for name in _page_names(page):
                counts[host, name] += 1
        if len(counts) > 200_000:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def _local_wrappers(batches):
    """One wrapper per host of all pages a task reads."""
    held: dict[str, dict] = {}
    keys_of: dict[str, Keys] = {}
    salt = TaskContext.get().partitionId() % SALTS

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held)), pa.array([salt] * len(held), pa.int32()),
             pa.array([_to_json(w) for w in held.values()])], names=["host", "salt", "wrapper"])

    for batch in batches:
        for host, page, stable in zip(*(column.to_pylist() for column in batch.columns)):
            if host not in held:
                keys_of[host] = Keys(stable or [])
            node = _node(read(page), keys_of[host])
            node["stable"] = sorted(keys_of[host].stable)
            # Only the wrapper is held, without the page's elements.
            held[host] = _merged([held[host], node]) if host in held else _from_json(_to_json(node))
        if len(held) > 20_000:
            yield rows()
            held.clear()
            keys_of.clear()
    if held:
        yield rows()


def _to_json(wrapper):
    return json.dumps([wrapper["stable"], _rows(wrapper)])


def _from_json(wrapper):
    stable, rows = json.loads(wrapper)
    return _from_rows(rows) | {"stable": stable}


def _merged(wrappers):
    return functools.reduce(_aligned, wrappers) | {"stable": wrappers[0]["stable"]}


def _merged_wrapper(table: pa.Table) -> pa.Table:
    wrapper = _merged([_from_json(w) for w in sorted(table.column("wrapper").to_pylist())])
    return pa.table({"host": table.column("host").slice(0, 1), "wrapper": [_to_json(wrapper)]})


def _host_part(table: pa.Table) -> pa.Table:
    wrapper = _merged([_from_json(w) for w in sorted(table.column("wrapper").to_pylist())])
    return pa.table({"host": table.column("host").slice(0, 1), "part": [json.dumps(main_part(wrapper))]})


def stable_names(pages: DataFrame) -> DataFrame:
    """(host, stable) from columns host and html: the names that enough of a host's pages have."""
    counts = pages.mapInArrow(_local_names, "host string, name string, n long")
    counts = counts.groupBy("host", "name").agg(F.sum("n").alias("n"))
    totals = counts.filter("name = ''").select("host", F.col("n").alias("pages"))
    names = counts.filter("name != ''").join(totals, "host").filter(_is_stable(F.col("n"), F.col("pages")))
    return materialize(names.groupBy("host").agg(F.sort_array(F.collect_list("name")).alias("stable")))


def _broadcast_if_small(rows: DataFrame, column) -> DataFrame:
    size = rows.agg(F.sum(F.octet_length("host") + F.octet_length(column))).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows


def host_parts(pages: DataFrame) -> DataFrame:
    """(host, part) from columns host and html: a row per host, from all its pages."""
    stable = _broadcast_if_small(stable_names(pages), F.concat_ws(" ", "stable"))
    # Copies collapse in the first task that sees them, so that pages are counted by content.
    distinct = pages.groupBy("host", F.sha2("html", 256).alias("digest")).agg(F.min("html").alias("html"))
    named = distinct.join(stable, "host", "left").select("host", "html", "stable")
    # At most one row per task and host.
    local = named.mapInArrow(_local_wrappers, "host string, salt int, wrapper string")
    some = local.groupBy("host", "salt").applyInArrow(_merged_wrapper, "host string, wrapper string")
    return materialize(some.groupBy("host").applyInArrow(_host_part, "host string, part string"))


def main_texts(pages: DataFrame, url_col="url", html_col="html") -> DataFrame:
    """`pages` with text and n_chars."""
    kept = pages.drop("text", "n_chars", "_host", "_part")
    host, _ = host_and_path(F.col(url_col))
    page = F.coalesce(F.col(html_col), F.lit(""))
    parts = host_parts(pages.select(host.alias("host"), page.alias("html")))
    parts = _broadcast_if_small(parts, "part").select(F.col("host").alias("_host"), F.col("part").alias("_part"))

    @F.arrow_udf("string")
    def texts(html: pa.Array, part: pa.Array) -> pa.Array:
        read_part = functools.lru_cache(maxsize=1000)(lambda p: _groups(json.loads(p)))
        return pa.array([_extracted(h, read_part(p)) for h, p in zip(html.to_pylist(), part.to_pylist())], pa.string())

    met = kept.withColumn("_host", host).join(parts, "_host")
    met = met.withColumn("text", texts(page, F.col("_part")))
    return met.select(*kept.columns, "text", F.length("text").cast("bigint").alias("n_chars"))
