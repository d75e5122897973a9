"""Page extraction and tool-call linking."""

import json
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cargoline.llm import chat, pages


def plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(8))
def test_common_lines_is_a_longest_subsequence(seed):
    import random

    rng = random.Random(seed)
    a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 15))] for _ in "xy")
    found = [a[i] for i in sorted(pages.common_lines(a, b))]
    assert len(found) == plain_lcs(a, b)
    assert any(list(c) == found for c in combinations(b, len(found)))


def page(body):
    return f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def test_markup_decides(spark):
    html = page(
        "<nav><ul><li>Menu</li></ul></nav><header>Top</header><article><header><h1>A &amp; B</h1></header><p>one\n two<br>three<p>four &lt;x&gt;"
        "<form>send</form><div class='comments'>said</div><aside>side</aside></p></article><div class=ad>Buy</div><footer>&copy;</footer>"
    )
    rows = [(1, "http://h/a", html), (2, "http://h/a/b", None), (3, None, ""), (4, "http://h/c", "<p>cut &amp; da<p cla"), (1, "http://h/a", html)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = sorted((r.page_id, r.text) for r in got.collect())
    article = "A & B\none two three\nfour <x>"
    assert texts == [(1, article), (1, article), (2, ""), (3, ""), (4, "cut & da")]
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_class_names_decide(spark):
    kept = ['class="no-comments post"', 'id="content" class="has-sidebar"', 'class="title share-price"', 'class="layout-sidebar-left"', 'class="commentary"', 'class="notice-of-intent"']
    gone = ['class=advertising', 'class="user-responses"', 'class="x site-footer"', 'id="share-buttons"', 'class="ad-2"', 'class="cookie_consent-dialog"', 'id=related-posts', 'class="Main-Nav"']
    bodies = [(f"<div {x}><p>Body {i}</p></div>", f"Body {i}") for i, x in enumerate(kept)] + [(f"<div {x}><p>Gone</p></div><p>Rest</p>", "Rest") for x in gone]
    rows = [(i, f"http://h{i}/a", page(body)) for i, (body, _) in enumerate(bodies)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {i: want for i, (_, want) in enumerate(bodies)}


def test_packed_lines_come_back():
    for lines in ([], [("one", 1), ("2 two \u00e9\udc80", 2)], [("x" * 10**6, 1)] * 3):
        digest, data = pages.packed(lines)
        assert pages.unpacked(data) == lines and digest == pages.packed(list(lines))[0]


def test_shared_template_lines_go_where_markup_is_silent(spark):
    one = "<div>Site name</div><div>First story, long enough to count.</div><div>Legal line</div>"
    two = "<div>Site name</div><div>Another story that differs a lot.</div><div>Legal line</div>"
    other = "<div>Site name</div><div>Lone</div>"
    rows = [(1, "http://h/x/1", one), (2, "http://h/x/2", two), (3, "http://g/1", other)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got == {1: "First story, long enough to count.", 2: "Another story that differs a lot.", 3: "Site name\nLone"}


def test_copies_do_not_delete_each_other(spark):
    story = "<div>Site name</div><div>The same story twice, under two addresses.</div>"
    df = spark.createDataFrame([(i, f"http://h/{i}", story) for i in range(3)], "page_id long, url string, html string")
    assert {r.text for r in pages.extract(df).collect()} == {"Site name\nThe same story twice, under two addresses."}


def test_template_goes_from_short_pages_and_beside_copies(spark):
    frame = "<div>Site name</div><div>Legal line, longer than any of the stories</div>"
    rows = [(i, f"http://h/{i:02}", f"{frame}<div>Story {i // 3}</div>") for i in range(24)]  # runs of three copies
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.extract(df).collect()} == {i: f"Story {i // 3}" for i in range(24)}


def test_texts_do_not_depend_on_partitions(spark):
    import random

    rng, rows = random.Random(5), []
    for i in range(300):
        host = rng.choice(["a", "b", "b", "b", "b", None])
        body = "".join(f"<div>{rng.choice('pqrstuvw') * rng.randrange(1, 12)}</div>" for _ in range(rng.randrange(0, 4)))
        rows.append((i, host and f"http://{host}/{rng.randrange(400)}", f"<div>{host} site</div>{body}<div>Legal line</div>"))
    df, seen = spark.createDataFrame(rows, "page_id long, url string, html string"), []
    settings = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(s) for s in settings]
    try:
        spark.conf.set(settings[1], "false")
        for n in (1, 7, 40):
            spark.conf.set(settings[0], n)
            seen.append({r.page_id: r.text for r in pages.extract(df).collect()})
    finally:
        for s, value in zip(settings, before):
            spark.conf.set(s, value)
    assert len(seen[0]) == 300 and seen[0] == seen[1] == seen[2]


def test_differencing_decides_beside_article_markup(spark):
    rows = [
        (i, f"http://h/{i}", f"<div>Site name</div><article><p>Story {c * 40}</p><div>Read all our stories</div></article><p>Afterword {c * 30}</p><div>Legal line</div>")
        for i, c in enumerate("abcde")
    ]
    rows.append((9, "http://g/1", "<article>Teaser</article><p>The main text stands outside of the only article.</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Story {c * 40}\nAfterword {c * 30}" for i, c in enumerate("abcde")}
    assert {r.page_id: r.text for r in pages.extract(df).collect()} == want | {9: "Teaser\nThe main text stands outside of the only article."}


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string, status string"


def test_calls_are_linked_ordered_and_checked(spark):
    schema = {"add": [("a", "BIGINT", True), ("note", "STRING", False)]}
    calls = [
        (1, "c", 1, "add", '{"note":"x", "a": 1}', "b", "z"), (1, "b", 2, "add", '{"a": "one"}', "a", None), (1, "a", 3, "add", "{}", None, None),
        (1, "e", 4, "add", "nonsense", "gone", None), (1, "f", 5, "other", '{"b":{"z":1,"y":[2, 1]}}', None, None),
        (2, "x", 1, "add", '{"a":1}', "y", None), (2, "y", 2, "add", '{"a":1}', "x", None), (2, "a", 9, "add", '[1]', None, None),
        (2, "a", 9, "add", '[1]', None, None), (3, None, 1, "add", None, None, None),
    ]
    results = [(1, "c", 7, "done"), (1, "b", 1, "early"), (1, "a", 8, None), (1, "lost", 9, "who"), (2, "x", 5, "ok"), (2, "y", 6, "ok")]
    got = chat.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"), schema)
    by = {(r.conv_id, r.call_id): r for r in got.collect()}
    assert len(by) == 10
    assert {k: (r.depth, r.status, list(r.errors)) for k, r in by.items()} == {
        (1, "c"): (2, "linked", []), (1, "b"): (1, "early_result", ["a: not BIGINT"]), (1, "a"): (0, "linked", ["a: missing"]),
        (1, "e"): (0, "no_result", ["not json"]), (1, "f"): (0, "no_result", ["unknown tool"]), (1, "lost"): (None, "orphan_result", []),
        (2, "x"): (None, "cycle", []), (2, "y"): (None, "cycle", []), (2, "a"): (0, "no_result", ["not an object", "a: missing", "repeated"]),
        (3, None): (None, "no_result", ["not json"]),
    }
    assert by[1, "c"].message == '{"arguments":{"a":1,"note":"x"},"id":"c","name":"add","result":"done"}'
    for r in by.values():
        m = json.loads(r.message)
        assert r.message == json.dumps(m, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    empty = chat.link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], "conv_id long, call_id string, turn long, content string"), schema)
    assert empty.count() == 0


def test_calls_that_wait_for_several_equal_brute_force(spark):
    rng = random.Random(3)
    calls = {(1, f"c{i}"): [f"c{i - 1}"] for i in range(40)}  # one long chain
    for conv in (2, 3, 4):
        for i in range(25):
            back = [f"c{j}" for j in range(i)] + ["gone"]
            calls[conv, f"c{i}"] = rng.sample(back, min(len(back), rng.choice([0, 1, 1, 2, 3]))) + [None]
    calls[3, "c4"] = ["c9", "c1"]  # perhaps a cycle
    calls[4, "c0"] = ["c0"]
    calls[4, "x"] = ["y", "c3"]
    calls[4, "y"] = ["x", "x"]
    calls[5, "alone"] = None
    depth = dict.fromkeys(calls)
    for _ in calls:  # settles one more level each time
        for (conv, name), after in calls.items():
            ups = [depth[conv, u] for u in {*(after or [])} if (conv, u) in calls]
            if None not in ups:
                depth[conv, name] = 1 + max(ups) if ups else 0
    df = spark.createDataFrame([(*k, v) for k, v in calls.items()], "conv_id long, call_id string, after array<string>")
    got = {(r.conv_id, r.call_id): r.depth for r in chat.depths(df).collect()}
    assert got == depth and depth[1, "c39"] == 39 and depth[4, "c0"] is None


def test_turns_of_other_roles_have_rows(spark):
    import duckdb

    turns = [(1, 0, "system", "s"), (1, 1, "user", "seven c"), (1, 2, "assistant", "a"), (1, 3, "tool", "t"), (1, 4, "assistant", None), (1, 5, None, "n"), (2, 0, "user", None)]
    calls, results, schemas = chat.conversation_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    found = chat.link_calls(calls, results, schemas).withColumn("errors", F.array_join("errors", "; "))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", turns)
    want = con.execute(chat.OP1_SQL).fetchall()
    names = [d[0] for d in con.description]
    got = [tuple(r[c] for c in names) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 5
    assert {r[names.index("turn")] for r in got if r[names.index("errors")] == "unknown tool"} == {3, 5}


def test_no_python_in_the_plan(spark, capsys):
    from tests.conftest import SF_SMALL

    from cargoline.llm.queries import QUERIES

    for name in ("op1_chat_formatting", "op4_benchmark_decontamination"):
        capsys.readouterr()
        QUERIES[name](spark, SF_SMALL).explain()
        plan = capsys.readouterr().out
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_chat_query_equals_sql(spark):
    import duckdb
    from tests.conftest import SF_SMALL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    want = con.execute(chat.OP1_SQL).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in chat.op1(spark, SF_SMALL).collect()))) == sorted(map(str, want))
