import pytest

from tessera.operators.untemplate import untemplated, untemplated_by
from tessera.plans.template import TemplateError, load_template, solutions, untemplate

CARD = """
<h2>{{ card.name }}</h2>
TYPE: {{ card.type }}<br>
{% if card.type == 'Hero' or card.type == 'Thing' %}
    {% if card.class is not none %}CLASS: {{ card.class }}<BR>{% endif %}
    {{ card.text }}<br>
{% elif card.type == 'Land' %}
    KIND: {{ card.kind }}<br>
{% endif %}
"""


@pytest.mark.parametrize(
    ("template", "text", "result"),
    [
        ("<hr>plain", "<HR> plain", (True, {})),
        ("{{ ware }}", "Lamp &amp; oil", (True, {"ware": "Lamp & oil"})),
        ("<td>{{ ware.name }}</td><td>{{ ware.price }}</td>", "<TD>Rope</TD>\n<td>9</td>", (True, {"ware": {"name": "Rope", "price": "9"}})),
        ("<li>{{ ware }}</li>", "<ul>Rope</ul>", (False, "Expected '<li>' at 1:1")),
        ("<h3>{{ ware }}</h3>{{ about|safe }}<hr>{{ note }}", "<h3>&quot;Pot&quot;</h3>iron<br>black<hr>&eacute;t&eacute;", (True, {"ware": '"Pot"', "about": "iron<br>black", "note": "été"})),
        ("{{ n|replace('Doz', 'Dz') }} pieces", "Dz pieces", (True, {"n": "Doz"})),
        ("Tags: {{ tags|join(', ') }};", "Tags: oil, brass, old;", (True, {"tags": ["oil", "brass", "old"]})),
        ("<b>{{ ware }}</b> costs less than <b>{{ ware }}</b>", "<b>Pot</b> costs less than <b>Pan</b>", (False, "Expected 'Pot' at 1:31")),
        ("{% for w in wares %}<li>{{ w.name }}: {% if w.old %}used{% else %}new{% endif %}</li>{% endfor %}", "<li>Pot: used</li><li>Pan: new</li>", (True, {"wares": [{"name": "Pot", "old": True}, {"name": "Pan", "old": False}]})),
        ("<ol>{% for w in shop.wares %}<li>{{ w }}</li>{% endfor %}</ol>", "<ol></ol>", (True, {"shop": {"wares": []}})),
        ("{% if shop.open %}<i>open</i>{% for w in shop.wares %}<li>{{ w }}</li>{% endfor %}{% endif %}", "<i>open</i><li>Pot</li>", (True, {"shop": {"open": True, "wares": ["Pot"]}})),
        ("{% if kind == 'pot' %}round{% else %}long{% endif %}", "long", (True, {})),
        ("{# not shown #}<hr>", "<hr>", (True, {})),
        ("{{ about }}", "", (True, {"about": ""})),
        ("{% for c in cs %}{{ c }}{% endfor %}<p>", "<p>", (True, {"cs": []})),
        (CARD, "<h2>A</h2>TYPE: Hero<br>CLASS: c<br>Unique.<br>", (True, {"card": {"class": "c", "name": "A", "text": "Unique.", "type": "Hero"}})),
        (CARD, "<h2>A</h2>TYPE: Thing<br>Unique.<br>", (True, {"card": {"class": None, "name": "A", "text": "Unique.", "type": "Thing"}})),
        (CARD, "<h2>A</h2>TYPE: Land<br>KIND: f<br>", (True, {"card": {"kind": "f", "name": "A", "type": "Land"}})),
        (CARD, "<h2>A</h2>TYPE: Other<br>", (True, {"card": {"name": "A", "type": "Other"}})),
    ],
)
def test_parse(template, text, result):
    assert load_template(template)(text) == result


def test_first_failure_furthest_on():
    ok, message = load_template("\n<body>\n  <h1>{{ t }}</h1>\n</body>")("<body>\n<h1>A title</h2>")
    assert not ok and message == "Expected '</h1>\\n</body>' at 2:12"


def test_tries_are_limited():
    t = load_template("{{ first }}{{ '-' }}{{ last }}<hr>")
    assert t("north-east-gate<hr>")[0]
    few = load_template("{{ first }}{{ '-' }}{{ last }}<hr>", max_tries=2)("north-east-gate<hr>")
    assert few[0] is False and few[1].startswith("Expected")


def test_long_lists_need_no_deep_stack():
    ok, got = load_template("{% for c in cs %}<p>{{ c.n }}</p>{% endfor %}")("<p>x</p>" * 20_000)
    assert ok and len(got["cs"]) == 20_000


def test_solutions_of_conditions():
    both = ("and", ("true", "x"), ("true", "y"))
    assert list(solutions(both, True)) == [{"x": True, "y": True}]
    assert list(solutions(both, False)) == [{"x": True, "y": False}, {"x": False, "y": True}, {"x": False, "y": False}]
    assert list(solutions(("and", ("true", "x"), ("not", ("true", "x"))), True)) == []
    three = ("or", ("or", ("true", "x"), ("true", "y")), ("true", "z"))
    assert len(list(solutions(three, True))) == 7 and list(solutions(three, False)) == [{"x": False, "y": False, "z": False}]


@pytest.mark.parametrize("bad", ["{% for x in y %}", "{{ a|upper }}", "{% if a %}", "{% while x %}", "{% if a is odd %}x{% endif %}", "{{ }}"])
def test_unsupported(bad):
    with pytest.raises(TemplateError):
        load_template(bad)


def test_files(tmp_path):
    (tmp_path / "t.jinja").write_text("<p>{{ a }}</p>", encoding="utf-8")
    (tmp_path / "s.html").write_bytes("<p>é</p>".encode("mac_roman"))
    assert untemplate(str(tmp_path / "t.jinja"), str(tmp_path / "s.html"), encoding="mac_roman") == {"a": "é"}
    (tmp_path / "s.html").write_text("<b>")
    with pytest.raises(ValueError, match="Expected"):
        untemplate(str(tmp_path / "t.jinja"), str(tmp_path / "s.html"))


def test_tables(spark, rows):
    df = spark.createDataFrame([(1, "<p>a</p>", "k"), (2, "<b>", "k"), (3, None, "k"), (4, "<p>a</p>", "z")], "id int, html string, kind string")
    got = untemplated(df, "id", "html", "<p>{{ x }}</p>").selectExpr("id", "ok", "to_json(result) r", "error")
    assert rows(got) == [(1, True, '{"x":"a"}', None), (2, False, None, "Expected '<p>' at 1:1"), (3, None, None, None), (4, True, '{"x":"a"}', None)]
    by = untemplated_by(df, "id", "html", "kind", {"k": "<p>{{ x }}</p>"}).where("id = 4").select("ok", "error")
    assert rows(by) == [(False, "no template for z")]
