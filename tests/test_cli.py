import json

from loomgraph import cli
from tests.test_graph import WIKI


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    for k, html in WIKI.items():
        (tmp_path / "in" / f"{k}.html").write_text(html)
    g = str(tmp_path / "g")
    cli.main(["extract", str(tmp_path / "in"), "--output", g, "--seeds", "Start"])
    assert {r.id for r in cli.load(spark, g)[0].collect()} == {"Start", "Next"}
    cli.main(["extract", str(tmp_path / "in"), "--output", g])
    cli.main(["markdown", g, "--output", str(tmp_path / "md")])
    assert (tmp_path / "md" / "Twin_2.md").exists()
    cli.main(["view", g, "--output", str(tmp_path / "v.html")])
    capsys.readouterr()
    cli.main(["lookup", g, "Start", "tw"])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {(r["name"], r["source"]) for r in out} == {("Start", "kb"), ("tw", "not_found")}
    cli.main(["search", g, "longer body", "--limit", "2"])
    # Start: (2 * 0.1161 / 1.6096 + 1.5 * 0.1161 / 0.1484) * 1.3 (neighbour) * 1.6 (PageRank) = 2.74; Twin_2: (2 + 1.5) * 0.6 (type) = 2.1
    hits = json.loads(capsys.readouterr().out)["results"]
    assert [(h["id"], round(h["score"], 2)) for h in hits] == [("Start", 2.74), ("Twin_2", 2.1)]
