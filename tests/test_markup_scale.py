import time

from gleanfield.operators.markup import Field, Rule, page_reader


def test_many_siblings_take_linear_time():
    page = "<ul>" + "".join(f"<li>{i}</li>" for i in range(4000)) + "</ul>"
    fields = {
        "nth": Field((Rule("li", nth=3999),)),
        "after": Field((Rule("li", after=Rule("li", own_text="10")),), "all_text"),
    }
    read = page_reader(fields)
    start = time.process_time()
    got = read(page)
    assert got["nth"] == "3998" and len(got["after"]) == 3989 and got["after"][0] == "11"
    assert time.process_time() - start < 1.0


def test_the_class_attribute_of_an_element_is_read_once_however_many_fields_ask(monkeypatch):
    from gleanfield.operators import markup

    seen = []
    read = markup._ATTR
    monkeypatch.setattr(markup, "_ATTR", type("Counted", (), {"findall": lambda self, written: seen.append(written) or read.findall(written)})())
    page = "".join(f'<div class="met-{i}"><b>{i}</b></div>' for i in range(50))
    fields = {f"f{i}": Field((Rule("div", any_class=(f"met-{i}",)), Rule("b"))) for i in range(50)}
    reading = page_reader(fields)
    for _ in range(3):
        assert reading(page) == {f"f{i}": str(i) for i in range(50)}
    assert len(seen) <= 50


def test_markup_of_elements_closed_by_others():
    page = "<!-- a --><ul>x<li>1 <b>2</b><li>3<br>4</ul>5<script>var a = '<li>'</script><p>6"
    got = page_reader({t: Field((Rule(t),), "all_html") for t in ("ul", "li", "script", "p")})(page)
    assert got == {
        "ul": ["<ul>x<li>1 <b>2</b><li>3<br>4</ul>"], "li": ["<li>1 <b>2</b>", "<li>3<br>4"],
        "script": ["<script>var a = '<li>'</script>"], "p": ["<p>6"],
    }
