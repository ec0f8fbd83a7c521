import html
import re
import unicodedata
from urllib import parse

from gleanfield.functions import places, text, urls

URLS = [
    "http://x.org/a?utm_source=f&page=2&ref=x#z", "http://x.org/a?utm_source=f",
    "http://x.org/?a=1&a=2&b=", "http://x.org/?q=a%20b", "mailto:a@x.org", "/rel?utm_x=1",
    "HTTP://X.org/A;p=1?k=v=w&flag&=e", "http://x.org/a;?#", "http://x.org?a=%zz&b=100%",
    "http://x.org/p;a/b;c?x=~*é ü+1", "  http://x.org/a\tb?c=1\n", "file:///a?b=1", "//h/p?q=1",
    "ftp://h;x/p;y", "foo:bar;baz?q=1", "http://[::1]:80/?a=b", "http://[x/?a=b", "", "plain",
    "http://x.org/?%61=1&a=2", "https://x.org/?a[]=1&utmost=3&b=%E2%82%AC",
]


def ref_unpack(u):
    o = parse.urlparse(u)
    return o, {k: v[0] for k, v in parse.parse_qs(o.query).items()}


def is_url(u):
    try:
        o = parse.urlparse(u)
    except ValueError:
        return False
    return bool(o.scheme and o.netloc)


def test_urls_against_stdlib(column):
    good = [u for u in URLS if "[x" not in u]
    for u, got in zip(good, column(urls.unpack_url, good)):
        o, q = ref_unpack(u)
        assert tuple(got)[:4] == tuple(o)[:4] and got["fragment"] == o.fragment, u
        assert [(p.k, p.v) for p in got["query"]] == list(q.items()), u
    for u, got in zip(good, column(lambda c: urls.pack_url(urls.unpack_url(c)), good)):
        o, q = ref_unpack(u)
        assert got == parse.urlunparse(o._replace(query=parse.urlencode(q))), u
    assert column(urls.is_url, URLS) == [is_url(u) for u in URLS]
    for u, got in zip(URLS, column(lambda c: urls.clean_url("v"), URLS)):
        expected = u
        if is_url(u):
            o, q = ref_unpack(u)
            q = {k: v for k, v in q.items() if not k.startswith("utm")}
            expected = parse.urlunparse(o._replace(query=parse.urlencode(q)))
        assert got == expected, u
    assert column(lambda c: urls.clean_url("v"), [None]) == [None]


def test_absolutise_and_mailto(column):
    assert column(lambda c: urls.absolutise("http://x", c), ["/a", None]) == ["http://x/a", None]
    hrefs = ["mailto:a%40b.c", "mailto:a+b@c", "a@b", "", "x:y:z%2", None]
    expected = [None if h is None else parse.unquote(h).split(":")[-1] for h in hrefs]
    assert column(urls.mailto_address, hrefs) == expected


def test_blanks(column):
    values = ["\t\xa0x ", "a\r\nb  c ", "\x1c y　", " ", "", None]
    stripped = [None if v is None else v.strip() for v in values]
    assert column(text.strip, values) == stripped
    assert column(text.blank_newlines, values) == [
        None if v is None else re.sub(r"\n|\r", " ", v) for v in stripped
    ]


def test_word_characters_and_capitalize(column):
    values = ["BIO: Expo, 2019", "San José", "éx", "a_b-c ½ ² 漢字 ª", "ÑÇ ß", ""]
    assert column(text.word_characters, values) == [re.sub(r"\W+", "", v.lower()) for v in values]
    assert column(text.capitalize, ["xYZ", "", "a"]) == ["Xyz", "", "A"]


def test_strip_accents_every_character(column):
    chars = "".join(chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000)
    values = ["Señor ß é", *[chars[i : i + 5000] for i in range(0, len(chars), 5000)]]
    expected = [unicodedata.normalize("NFD", v).encode("ascii", "ignore").decode() for v in values]
    assert column(text.strip_accents, values) == expected


def test_unescape(column):
    values = ["&copy; &middot; &amp;amp; &#233; &notit; &bogus;", "plain", "", None]
    assert column(text.html_unescape, values) == [v and html.unescape(v) for v in values]


def test_contacts(column):
    one, none, many, null = column(
        text.contact_blocks,
        [
            "Petro summit. Contact Info: Christeena Jones | p@x.com | 44-203 Contact Info: | | | Event Website",
            "no contact", "x Contact Info:a | b | c |", None,
        ],
    )
    assert tuple(one) == ("Petro summit. ", "Christeena Jones", "p@x.com", "44-203", True)
    assert not none["ok"] and not many["ok"] and null is None
    got = column(
        text.labelled_contacts,
        ["Phone: +49-89-949-203-81, Fax: +49-89-949-203-89, eMail: info@Analytica.de", "Phone: a:b"],
    )
    assert tuple(got[0]) == ("info@analytica.de", "+49-89-949-203-81", "+49-89-949-203-89", True)
    assert not got[1]["ok"]
    got = column(
        text.info_names,
        ["About. Info: Green Power Conferences, Robert Wilson", "About.", "Info: eMail: x"],
    )
    assert tuple(got[0]) == ("About. Info: ", "Green Power Conferences", "Robert Wilson", True)
    assert tuple(got[1]) == ("About.", "", "", True)
    assert not got[2]["ok"]


def test_small_texts(column):
    assert column(text.price_text, ["from AUD 1,250.00 incl. GST", "free", None]) == ["1,250.00", None, None]
    assert column(text.after_label, ["Date: 1: 2 ", "none", ""]) == ["1: 2", "none", ""]
    assert column(text.br_parts, ["<p>a<br>b<BR/>c"]) == [["<p>a", "b", "c"]]
    assert column(text.after_last_tag, ['<div class="x">Hall', "Hall"]) == ["Hall", "Hall"]
    assert column(text.squeeze, [" a\n\n b\t"]) == ["a b"]
    assert column(lambda c: text.compose_description(c, c), ["a", None]) == ["a\na", "\n"]


def test_places(column):
    got = column(places.address_tail, ["Rue 1, 4000 Basel, Switzerland", "Basel", None])
    assert [v and tuple(v) for v in got] == [(" 4000 Basel", " Switzerland"), ("", "Basel"), None]
    got = column(places.city_state_country, ["Boston, MA, USA", "Berlin, Germany", "Singapore"])
    assert [tuple(v) for v in got] == [
        ("Boston", "MA", "USA"), ("Berlin", None, "Germany"), ("Singapore", None, "Singapore")
    ]
    got = column(places.city_paren_country, ["Basel (CH)", "Basel", ""])
    assert [tuple(v) for v in got] == [("Basel", "CH"), ("Basel", None), ("", None)]
    got = column(places.venue_city, ["Hall 1, London", "Hall 1", "", "a, b, c"])
    assert [v and tuple(v) for v in got] == [("Hall 1", "London"), ("Hall 1", ""), ("", ""), None]


def test_unescape_whole_references_only(column):
    values = ["a &amp; &amp b &quot", "&copy; &#233; &bogus;", None]
    assert column(lambda c: text.html_unescape(c, whole=True), values) == ["a & &amp b &quot", "© é &bogus;", None]


def test_clean_urls_are_left_as_they_are(column):
    left = ["http://x.org", "http://x.org/a/b-c_d.html", "https://x.org/?id=7", "http://x.org?id=a.b-c"]
    changed = {
        "http://x.org/?utm_source=7": "http://x.org/", "http://x.org/a?": "http://x.org/a", "http://x.org/a;": "http://x.org/a",
        "HTTP://x.org/": "http://x.org/", "http://x.org/a\n": "http://x.org/a", "http://x.org/?a=1&a=2": "http://x.org/?a=1",
        "http://x.org/?a=": "http://x.org/", "http://x.org/?a=b c": "http://x.org/?a=b+c",
    }
    shortcut = re.compile(urls._CLEAN_ALREADY.format(prefix="utm").replace(r"\z", r"\Z"))
    assert all(map(shortcut.match, left)) and not any(map(shortcut.match, changed))
    assert column(lambda c: urls.clean_url("v"), [*left, *changed]) == [*left, *changed.values()]
