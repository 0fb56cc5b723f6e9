from pyspark.sql import functions as F

from loomsift.llm.html_extract import Page, extract, page_votes

from .test_html_extract import of


def run(spark, markup):
    df = spark.createDataFrame([(i, f"http://h.com/{i}", markup) for i in range(4)], "page_id long, url string, html string")
    return extract(df).filter("page_id = 3").first()


def test_parts_of_one_path(spark):
    one, two = "part one " * 77, "part two " * 55
    got = run(spark, f"<body><div class=part-1><p>{one}</p></div><div class=part-2><p>{two}</p></div></body>")
    assert got["text"] == f"{one.strip()}\n{two.strip()}"
    assert got["path"] == "body"  # once a page: 0.83 for the parts, 1 for body


def test_all_elements_of_the_path():
    p = Page("<body><div class=part-1>one</div><div class=other>no</div><div class=part-2>two <div class=share>s</div>x</div><div class=part-3><a>link</a></div></body>")
    assert p.main(of("body>div.part-#")) == "one\ntwo\nx"
    cells = "".join(f"<tr><td>c{i}</td></tr>" for i in range(5000))
    assert Page(f"<table>{cells}</table>").main(of("table>tr>td")).count("\n") == 4999


def test_wrapper_blocks(spark):
    lead, body = "lead words " * 27, "body words " * 109
    page = f"<body><nav>menu</nav><div id=content><h1>Headline</h1><p>{lead}</p><ul><li><a>Home</a> | <a>About</a></ul><div class=sidebar>side</div><div class=text><p>{body}</p></div><p>End.</p></div><footer>f</footer></body>"
    got = run(spark, page)
    assert got["path"] == "body>div>div.text"
    assert got["text"] == f"Headline\n{lead.strip()}\n{body.strip()}\nEnd."
    assert got["n_chars"] == len(got["text"])


def test_wrapper_ends_at_article():
    words = "words " * 50
    assert Page(f"<body><p>outside</p><article><h2><a>Linked</a></h2><div class=t>{words}</div></article></body>").main(of("body>article>div.t")) == f"Linked\n{words.strip()}"
    assert Page(f"<body><p>outside</p><article>{words}</article></body>").main() == words.strip()


def test_all_containers_vote(spark):
    boxes = [f"{i:b}".translate(str.maketrans("01", "xy")) for i in range(8, 16)]
    page = "<body>{}<div class=text><p>{}</p></div></body>"
    rows = []
    for i, b in enumerate(boxes):
        varying = "".join(f"<div class={b}{c}>{'box words ' * 30}</div>" for c in "abcd")
        rows.append((i, f"http://h.com/{i}", page.format(varying, "the text " * 20)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    sums = {r["path"]: r["n"] for r in page_votes(df).groupBy("path").agg(F.sum("vote").alias("n")).collect()}
    want = {}
    for _, _, markup in rows:
        p = Page(markup)
        scores = {k: n for k, n in p.scores().items() if k}
        for path in {p.paths[k] for k in scores}:
            best = max(n for k, n in scores.items() if p.paths[k] == path)
            want[path] = want.get(path, 0) + round(1e6 * best / max(scores.values()))
    assert sums == want and sums[of("body>div.text")] > 0 and len(sums) == 4 * len(boxes) + 2
