"""Element rules and the per-page helper that applies them inside a Python task.

The rules cover the few ways records are located in pages: by tag, class, attribute,
label, position, sibling and content. A page is read once into flat lists (one entry
per element, in document order) and all fields are answered from those.
"""

import re
from bisect import bisect_left
from dataclasses import dataclass
from html import unescape
from html.entities import html5
from itertools import accumulate

import pyarrow as pa


@dataclass(frozen=True)
class Rule:
    """Conditions on one element; all given ones must hold."""

    tag: str | None = None
    any_class: tuple[str, ...] = ()  # has one of these class tokens
    all_class: tuple[str, ...] = ()  # has all of these class tokens
    class_like: str | None = None  # class attribute contains this text
    class_eq: str | None = None  # class attribute is this text
    attr: tuple[str, str, str] | None = None  # (name, exists|equals|prefix|contains, value)
    own_text: str | None = None  # one of its own text pieces is this text
    no_text: bool = False  # has no own text piece
    nth: int | None = None  # n-th among its siblings of the same tag
    first: int | None = None  # n-th of all matches
    child: bool = False  # direct child of the previous step, else any descendant
    has: "Rule | None" = None  # has such a descendant (or child, if that rule says so)
    after: "Rule | None" = None  # an earlier sibling matches


@dataclass(frozen=True)
class Field:
    """Where a value is and what to take from there.

    `take` is one of `first_text`, `all_text`, `string`, `all_string`, `norm_text`, `html`,
    `all_html`, `attr:NAME`, `all_attr:NAME`, or `rows` (one struct of `sub` fields
    per matched element).
    """

    path: tuple[Rule, ...]
    take: str = "first_text"
    default: str | None = None
    sub: "dict[str, Field] | None" = None


# Elements without content, and for an opening tag the open elements it
# closes when they are innermost (as lenient HTML readers do).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": "li p h1 h2 h3 h4 h5 h6 dl pre address".split(),
    "dt": "dt dd p".split(),
    "dd": "dt dd p".split(),
    "td": "td th p a b i u font span".split(),
    "th": "td th p a b i u font span".split(),
    "tr": "tr td th p caption".split(),
    "tbody": "thead tbody tr td th p caption".split(),
    "tfoot": "thead tbody tr td th p".split(),
    "option": ["option"],
    "body": ["head"],
    "p": "p b big i small tt u h1 h2 h3 h4 h5 h6".split(),
}
CLOSES.update(
    dict.fromkeys(
        "div ul ol dl table form h1 h2 h3 h4 h5 h6 hr pre address article aside section nav "
        "header footer main fieldset blockquote center".split(),
        ["p"],
    )
)
# An end tag does not reach past an open element of higher rank.
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180,
        "table": 190, "head": 200, "body": 200, "html": 220}

_ATTRS = r"([^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+)"
# Splits a page into a text, a token, then of a script or style its name, attributes and content,
# of other tags the name (behind a "/" if it ends one) and attributes, and so on to a last text.
_TOKEN = re.compile(
    r"(<(?:!--.*?(?:-->|\Z)|[!?][^>]*>"
    rf"|((?i:script|style))(?=[\s>]){_ATTRS}>(.*?)(?=</(?i:script|style)|\Z)"
    rf"|(/?(?i:[a-z])[^\s/>]*){_ATTRS}>))",
    re.S,
)
_PARTS = 7
_ATTR = re.compile(r"([^\s=>/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_BLANKS = re.compile("[ \t\r\n]+")

# Positions within an element's entry. BEGIN and END count texts and tokens alike.
TAG, PARENT, ATTRS, BEGIN, END, LAST, FIRST_RUN, END_RUN = range(8)


def _remembered(read):
    """`read` of an element's attributes as written, for short ones remembered over pages, as most are met again."""
    known = {}

    def remembered(written):
        found = known.get(written)
        if found is None:
            found = read(written)
            if len(written) < 200:
                if len(known) >= 4096:
                    known.clear()
                known[written] = found
        return found

    return remembered

_REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|[A-Za-z][A-Za-z0-9]*;)")


def decoded(text):
    """Character references decoded as lenient HTML 4 readers do: a named one must end in `;` and be known as a whole."""
    return _REFERENCE.sub(_character, text)


def _character(reference):
    written = reference[0]
    return unescape(written) if written[1] == "#" else html5.get(written[1:], written)


@_remembered
def _attributes(written):
    found = {}
    for name, value in _ATTR.findall(written):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), decoded(value) if "&" in value else value)
    return found


class Page:
    """Elements of one page in document order; element 0 is the page itself.

    `runs` are the pieces of text as (text, owning element).
    """

    def __init__(self, text, pieces=None):
        self.pieces = _TOKEN.split(text) if pieces is None else pieces
        self.elements = [["", -1, "", 0, 0, 0, 0, 0]]
        self.runs = []
        self.by_tag = {}
        self.found = {}  # elements by path prefix and context, shared by the fields
        self.matched = {}  # elements of a step's tag and attributes
        self._texts, self._numbers, self._firsts = {}, {}, {}
        self._read()

    def _read(self):
        pieces, elements, runs, by_tag = self.pieces, self.elements, self.runs, self.by_tag
        open_, at = [0], 1
        parts = iter(pieces)
        for text, _, raw, raw_attrs, inside, tag, attrs in zip(*[parts] * _PARTS):
            if text:
                runs.append((text, open_[-1]))
            at += 2
            if raw is not None:
                tag, attrs = raw, raw_attrs
            elif tag is None:
                continue
            elif tag[0] == "/":
                tag = tag[1:].lower()
                innermost = elements[open_[-1]]
                if innermost[TAG] == tag:
                    open_.pop()
                    innermost[END] = at - 1
                    innermost[LAST] = len(elements) - 1
                    innermost[END_RUN] = len(runs)
                else:
                    self._end(open_, tag, at - 2)
                continue
            tag = tag.lower()
            closes = CLOSES.get(tag)
            while closes and elements[open_[-1]][TAG] in closes:
                self._close(open_, at - 2)
            index = len(elements)
            elements.append([tag, open_[-1], attrs, at - 2, at - 1, index, len(runs), len(runs)])
            if tag in by_tag:
                by_tag[tag].append(index)
            else:
                by_tag[tag] = [index]
            if tag not in VOID:
                open_.append(index)
                if inside:
                    runs.append((inside, index))
        if pieces[-1]:
            runs.append((pieces[-1], open_[-1]))
        while open_:
            self._close(open_, at)

    def _close(self, open_, end):
        element = self.elements[open_.pop()]
        element[END] = end
        element[LAST] = len(self.elements) - 1
        element[END_RUN] = len(self.runs)

    def _end(self, open_, tag, at):
        elements, rank = self.elements, RANK.get(tag, 100)
        for depth in range(len(open_) - 1, 0, -1):
            name = elements[open_[depth]][TAG]
            if name == tag:
                while len(open_) > depth + 1:
                    self._close(open_, at)
                self._close(open_, at + 1)
                return
            if RANK.get(name, 100) > rank:
                return

    def attributes(self, i):
        return _attributes(self.elements[i][ATTRS])

    def own_texts(self, i):
        texts = self._texts.get(i)
        if texts is None:
            element = self.elements[i]
            texts = self._texts[i] = [
                self._decoded(run)
                for run in self.runs[element[FIRST_RUN] : element[END_RUN]]
                if run[1] == i
            ]
        return texts

    def _decoded(self, run):
        piece, owner = run
        if "&" in piece and self.elements[owner][TAG] not in ("script", "style"):
            return decoded(piece)
        return piece

    def places(self):
        """The piece each run is: its index, or `~index` where references in it are not decoded."""
        at = [i for i, piece in enumerate(self.pieces) if piece and i % _PARTS in (0, 4)]
        return [~i if self.elements[owner][TAG] in ("script", "style") else i for i, (_, owner) in zip(at, self.runs)]

    def attributes_at(self, i):
        """The piece that holds an element's attributes."""
        start = self.elements[i][BEGIN] // 2 * _PARTS
        return start + (6 if self.pieces[start + 2] is None else 3)

    def number(self, i):
        """Place of an element among its siblings of the same tag, from 1."""
        parent = self.elements[i][PARENT]
        numbers = self._numbers.get(parent)
        if numbers is None:
            numbers, seen = {}, {}
            for j in self.children(parent):
                tag = self.elements[j][TAG]
                seen[tag] = numbers[j] = seen.get(tag, 0) + 1
            self._numbers[parent] = numbers
        return numbers[i]

    def first_child(self, parent, name, test):
        """The first child for which `test` holds; looked for once per `name`."""
        key = (parent, name)
        if key not in self._firsts:
            self._firsts[key] = next((j for j in self.children(parent) if test(self, j)), None)
        return self._firsts[key]

    def children(self, parent):
        j, end = parent + 1, self.elements[parent][LAST]
        while j <= end:
            yield j
            j = self.elements[j][LAST] + 1


def _by_class(rule):
    """What the class attribute of an element must satisfy, as a function of its value, or None."""
    if not (rule.any_class or rule.all_class or rule.class_like or rule.class_eq):
        return None

    def match(value):
        tokens = _BLANKS.split(value)
        return (
            (not rule.any_class or any(c in tokens for c in rule.any_class))
            and all(c in tokens for c in rule.all_class)
            and (not rule.class_like or rule.class_like in value)
            and (not rule.class_eq or rule.class_eq == value)
        )

    return match


def _by_value(attr):
    """What an attribute's value (None where it is missing) must satisfy."""
    _, how, wanted = attr
    return {
        "exists": lambda value: value is not None,
        "equals": lambda value: value == wanted,
        "prefix": lambda value: value is not None and value.startswith(wanted),
        "contains": lambda value: value is not None and wanted in value,
    }[how]


def _by_attributes(rule):
    """What the attributes of an element must satisfy, as a function of them as written, or None."""
    classed, valued = _by_class(rule), rule.attr and _by_value(rule.attr)
    if not classed and not valued:
        return None

    def match(written):
        if classed and "class" not in written.lower():
            return False
        found = _attributes(written)
        if classed and not classed(found.get("class", "")):
            return False
        return not valued or valued(found.get(rule.attr[0]))

    return _remembered(match)


def _rules(field):
    """All rules a field uses."""
    asked = [*field.path, *[r for f in (field.sub or {}).values() for r in _rules(f)]]
    for rule in asked:
        yield rule
        asked += [r for r in (rule.has, rule.after) if r is not None]


class _Signatures(dict):
    """What the rules' tests of classes and values say of attributes as written; short ones are remembered over pages."""

    def __init__(self, rules):
        rules = dict.fromkeys(rules)
        classed = [t for t in map(_by_class, rules) if t is not None]
        self.classed = _remembered(lambda value: tuple([test(value) for test in classed]))
        self.valued = [(attr[0], _by_value(attr)) for attr in dict.fromkeys(r.attr for r in rules if r.attr)]
        self.names = [*dict.fromkeys(name for name, _ in self.valued), *(["class"] if classed else [])]

    def __missing__(self, written):
        lowered = (written or "").lower()
        for name in self.names:
            if name in lowered:
                break
        else:
            if not written:
                self[written] = 0
            return 0
        found = _attributes(written)
        signature = self.classed(found.get("class", "")), *[test(found.get(name)) for name, test in self.valued]
        if len(written) < 200:
            if len(self) >= 4096:
                self.clear()
            self[written] = signature
        return signature


def _tests(rule):
    """What an element of the right tag and attributes must satisfy, as functions of page and element."""
    tests = []
    if rule.own_text is not None:
        tests.append(lambda page, i: rule.own_text in page.own_texts(i))
    if rule.no_text:
        tests.append(lambda page, i: not page.own_texts(i))
    if rule.nth is not None:

        def is_nth(page, i):
            return page.number(i) == rule.nth

        tests.append(is_nth)
    if rule.has is not None:
        inner = _step(rule.has)
        tests.append(lambda page, i: bool(inner(page, [i], False)))
    if rule.after is not None:
        earlier, match, tag, name = _tests(rule.after), _by_attributes(rule.after), rule.after.tag, object()

        def is_earlier(page, j):
            element = page.elements[j]
            if tag is not None and tag != element[TAG] or match is not None and not match(element[ATTRS]):
                return False
            return all(t(page, j) for t in earlier)

        def is_after(page, i):
            first = page.first_child(page.elements[i][PARENT], name, is_earlier)
            return first is not None and first < i

        tests.append(is_after)
    return tests


def _step(rule):
    """One step of a path: from some elements to those the rule finds, in document order."""
    tests, match, tag, child, name = _tests(rule), _by_attributes(rule), rule.tag, rule.child, object()

    def step(page, contexts, own):
        elements, found = page.elements, []
        matched = page.matched.get(name)
        if matched is None:
            matched = page.by_tag.get(tag, ()) if tag else range(1, len(elements))
            if match is not None:
                matched = [i for i in matched if match(elements[i][ATTRS])]
            page.matched[name] = matched
        if not matched:
            return found
        for c in contexts:
            candidates = matched
            if c:
                low, high = c if own and not child else c + 1, elements[c][LAST] + 1
                candidates = matched[bisect_left(matched, low) : bisect_left(matched, high)]
            for i in candidates:
                if child and elements[i][PARENT] != c:
                    continue
                for test in tests:
                    if not test(page, i):
                        break
                else:
                    found.append(i)
        if len(contexts) > 1:
            found = sorted(set(found))
        return found if rule.first is None else found[rule.first - 1 : rule.first]

    return step


def _text(pieces, at):
    if at < 0:
        return pieces[~at]
    piece = pieces[at]
    return decoded(piece) if "&" in piece else piece


def _string(pieces, runs, span):
    low, high = span
    return "".join([_text(pieces, at) for at in runs[low:high]])


def _markup(pieces, span):
    """Texts and tokens from one place to another, as written."""
    begin, end = span
    units = [""] * (end - begin)
    units[begin % 2 :: 2] = pieces[(begin + 1) // 2 * _PARTS : (end + 1) // 2 * _PARTS : _PARTS]
    units[1 - begin % 2 :: 2] = pieces[begin // 2 * _PARTS + 1 : end // 2 * _PARTS + 1 : _PARTS]
    return "".join(units)


def _locator(field, prefixes):
    """Where the field's values are, as a function of page and context element.

    The answer names pieces, runs or units of the page. It follows from the page's layout alone.
    Fields made with the same `prefixes` look up a common beginning of their paths once.
    """
    steps = []
    for n, rule in enumerate(field.path):
        number = len(prefixes)
        steps.append(prefixes.setdefault(field.path[: n + 1], (number, _step(rule))))
    what = field.take.partition(":")[0]
    sub = [_locator(f, prefixes) for f in field.sub.values()] if what == "rows" else None

    def locate(page, places, context=0):
        found, own = [context], context != 0
        for number, step in steps:
            known = page.found.get((number, context))
            if known is None:
                known = page.found[number, context] = step(page, found, own)
            found, own = known, False
            if not found:
                break
        elements = page.elements
        if what == "rows":
            return [[s(page, places, i) for s in sub] for i in found]
        if what in ("first_text", "all_text"):
            spans = ((i, elements[i][FIRST_RUN], elements[i][END_RUN]) for i in found)
            own_runs = (places[r] for i, low, high in spans for r in range(low, high) if page.runs[r][1] == i)
            return next(own_runs, None) if what == "first_text" else list(own_runs)
        if what in ("attr", "all_attr"):
            return [page.attributes_at(i) for i in found]
        begin, end = (BEGIN, END) if what.endswith("html") else (FIRST_RUN, END_RUN)
        return [(elements[i][begin], elements[i][end]) for i in (found if what.startswith("all_") else found[:1])]

    return locate


def _taker(field):
    """The field's value, as a function of pieces, places of runs and what its locator says."""
    what, _, name = field.take.partition(":")
    default = field.default
    if what == "first_text":
        return lambda pieces, runs, at: default if at is None else _text(pieces, at)
    if what == "all_text":
        return lambda pieces, runs, found: [_text(pieces, at) for at in found]
    if what == "all_html":
        return lambda pieces, runs, found: [_markup(pieces, span) for span in found]
    if what == "all_string":
        return lambda pieces, runs, found: [_string(pieces, runs, span) for span in found]
    if what == "html":
        return lambda pieces, runs, found: _markup(pieces, found[0]) if found else default
    if what == "rows":
        subs = [_taker(f) for f in field.sub.values()]
        return lambda pieces, runs, found: [[take(pieces, runs, at) for take, at in zip(subs, row)] for row in found]
    if what in ("attr", "all_attr"):

        def attributes(pieces, runs, found):
            values = [_attributes(pieces[at]).get(name) for at in found]
            values = [v for v in values if v is not None]
            return values if what == "all_attr" else (values[0] if values else default)

        return attributes

    def string(pieces, runs, found):
        if not found and default is not None:
            return default
        value = _string(pieces, runs, found[0]) if found else ""
        return _BLANKS.sub(" ", value).strip(" ") if what == "norm_text" else value

    return string


def _named(field, value):
    """A value of `rows` with the names of its fields."""
    if field.take != "rows":
        return value
    return [{k: _named(f, v) for (k, f), v in zip(field.sub.items(), row)} for row in value]


def reader(field):
    """The field as a function of page and context element."""
    locate, take = _locator(field, {}), _taker(field)

    def read(page, context=0):
        places = page.places()
        return _named(field, take(page.pieces, places, locate(page, places, context)))

    return read


# Layouts remembered by a reader: their tokens in all, and those of one page.
_LAYOUT_TOKENS, _LONG_LAYOUT = 200_000, 2_000


class _Layouts:
    """Where the fields' values are in a page, remembered over pages of the same layout.

    The rules ask for tags and their order, for what their attribute tests say, which texts are
    empty and which are one of the texts they name. Pages alike in these have all values at the same places.
    """

    def __init__(self, fields):
        prefixes, rules = {}, [r for f in fields.values() for r in _rules(f)]
        self.locators = [_locator(f, prefixes) for f in fields.values()]
        self.signatures = _Signatures(rules)
        self.kinds = {"": 0} | {r.own_text: r.own_text for r in rules if r.own_text}
        self.known, self.tokens = {}, 0

    def _kind(self, text):
        """0 for no text (1 for None), a text the rules name, as written or decoded, or 1."""
        if text and "&" in text and text not in self.kinds:
            meant = decoded(text)
            return ("&", meant) if meant in self.kinds else 1
        return self.kinds.get(text, 1)

    def _key(self, text, pieces):
        signed, kinds = self.signatures.__getitem__, self.kinds.get
        texts, raw, rest = pieces[0::_PARTS], pieces[2::_PARTS], ()
        if len(self.kinds) > 1 and "&" in text:
            seen = tuple(map(self._kind, texts))
        else:
            seen = tuple([kinds(t, 1) for t in texts])
        if raw.count(None) != len(raw):
            rest = (*raw, *map(signed, pieces[3::_PARTS]), *map(self._kind, pieces[4::_PARTS]))
        return tuple(pieces[5::_PARTS]), tuple(map(signed, pieces[6::_PARTS])), seen, rest

    def of(self, text, pieces):
        """Places of the page's runs, and of each field's values."""
        tokens = len(pieces) // _PARTS
        key = self._key(text, pieces) if tokens <= _LONG_LAYOUT else None
        layout = self.known.get(key)
        if layout is None:
            page = Page(text, pieces)
            places = page.places()
            layout = places, [locate(page, places) for locate in self.locators]
            if key is not None:
                if self.tokens + tokens > _LAYOUT_TOKENS:
                    self.known.clear()
                    self.tokens = 0
                self.known[key] = layout
                self.tokens += tokens + 1
        return layout


def values_reader(fields):
    """All fields of a page in one reading of it, as a list in their order; rows are such lists."""
    layouts, takers = _Layouts(fields), [_taker(f) for f in fields.values()]

    def read(text):
        pieces = _TOKEN.split(text)
        runs, found = layouts.of(text, pieces)
        return [take(pieces, runs, at) for take, at in zip(takers, found)]

    return read


def page_reader(fields):
    """All fields of a page in one reading of it, by name."""
    read = values_reader(fields)
    return lambda text: {k: _named(f, v) for (k, f), v in zip(fields.items(), read(text))}


# What may begin a token, and what may in a text that goes on.
_BEGINNING = re.compile(r"<(?:[!?]|/?(?i:[a-z]))")
_QUOTES = ("'", '"')
_CUT_OFF = re.compile(r"<(?:[!?]|/?(?i:[a-z])|/?\Z)")


def can_skim(fields):
    """Whether the fields ask for attributes only, of elements told by their ancestors, place and own attributes."""
    return all(
        f.take.partition(":")[0] in ("attr", "all_attr")
        and f.path
        and not any(r.own_text is not None or r.no_text or r.has or r.after for r in f.path)
        for f in fields.values()
    )


def _tokens(text):
    """The parts of `_TOKEN.split` by token. Of a long text, which holds a token without an end, one at a time."""
    if len(text) <= 1 << 20:
        parts = iter(_TOKEN.split(text))
        yield from zip(*[parts] * _PARTS)
        return
    at = 0
    for token in _TOKEN.finditer(text):
        yield text[at : token.start()], *token.groups()
        at = token.end()


class Skimmer:
    """Fields of a page that comes in pieces, for fields that `can_skim` allows.

    Only open elements, the values `found` (a list per field) and a token cut off at the end of a piece are kept.
    Elements are told as `Page` tells them.
    """

    def __init__(self, fields):
        self.found = [[] for _ in fields]
        self.rest, self.steps, root, bit = "", [], 0, 1
        for values, field in zip(self.found, fields.values()):
            root |= bit
            what, _, name = field.take.partition(":")
            for n, rule in enumerate(field.path, 1):
                take = (values, name, what == "attr") if n == len(field.path) else None
                # `bit` of the context, the next one of what is found there; the last is how many were
                self.steps.append((rule, _by_attributes(rule), bit, bit << 1, take, [0]))
                bit <<= 1
            bit <<= 1
        self.numbered = any(r.nth is not None for r, *_ in self.steps)
        # open elements: name, what is found here, what is found here or around, children by name
        self.open_ = [("", root, root, {})]
        self.tags = {}

    def feed(self, text, last):
        """The next piece of the page; nothing comes after the `last`."""
        buffer = self.rest + text
        open_, tags, numbered, at, size = self.open_, self.tags, self.numbered, 0, len(buffer)
        for before, token, raw, raw_attrs, _, tag, attrs in _tokens(buffer):
            end = at + len(before) + len(token)
            # With more text this token might end elsewhere, or one before it begin.
            if not last and (end == size or "<" in before and _BEGINNING.search(before)):
                break
            if tag is None:
                if raw is None:
                    at = end
                    continue
                tag, attrs = raw, raw_attrs
            name, ends, closes, steps, quoted = tags.get(tag) or self._tag(tag)
            if not last and (quoted or attrs and attrs[0] in _QUOTES):
                break
            at = end
            if ends:
                if open_[-1][0] == name:
                    open_.pop()
                else:
                    self._ended(name)
                continue
            while closes and open_[-1][0] in closes:
                open_.pop()
            _, above, around, children = open_[-1]
            here = 0
            if numbered:
                children[name] = children.get(name, 0) + 1
            for rule, match, context, bit, take, seen in steps:
                if not (above if rule.child else around) & context or match is not None and not match(attrs):
                    continue
                if rule.nth is not None and rule.nth != children[name]:
                    continue
                seen[0] += 1
                if rule.first is not None and rule.first != seen[0]:
                    continue
                here |= bit
                if take is not None:
                    values, wanted, once = take
                    value = _attributes(attrs).get(wanted)
                    if value is not None and not (once and values):
                        values.append(value)
            if name not in VOID:
                open_.append((name, here, around | here, {} if numbered else None))
        cut = None if last else _CUT_OFF.search(buffer, at)
        self.rest = buffer[cut.start() :] if cut else ""

    def _tag(self, written):
        """Of a tag as written: name, whether it ends an element, what it closes, the steps that ask for it, whether it holds quotes."""
        ends = written[0] == "/"
        name = written[1:].lower() if ends else written.lower()
        steps = [s for s in self.steps if s[0].tag in (None, name)]
        known = name, ends, CLOSES.get(name), steps, "'" in written or '"' in written
        if len(self.tags) >= 4096:
            self.tags.clear()
        self.tags[written] = known
        return known

    def _ended(self, tag):
        open_, rank = self.open_, RANK.get(tag, 100)
        for depth in range(len(open_) - 1, 0, -1):
            name = open_[depth][0]
            if name == tag:
                del open_[depth:]
                return
            if RANK.get(name, 100) > rank:
                return


def arrow_structs(records, struct):
    """Lists of values, or None, as an Arrow array of structs, built by column: by record, each name is looked up."""
    empty = [None] * struct.num_fields
    columns = zip(*[empty if r is None else r for r in records]) if records else [()] * struct.num_fields
    arrays = []
    for values, field in zip(columns, struct):
        kind = field.type
        if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
            ends = list(accumulate((len(v or ()) for v in values), initial=0))
            rows = arrow_structs([row for v in values if v for row in v], kind.value_type)
            none = pa.array([v is None for v in values], pa.bool_())
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, type=kind, mask=none))
        else:
            arrays.append(pa.array(values, kind))
    return pa.StructArray.from_arrays(arrays, fields=list(struct), mask=pa.array([r is None for r in records], pa.bool_()))
