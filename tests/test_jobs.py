from helpers import rows

from tradeflow.__main__ import main
from tradeflow.sources.store import TradeStore


def test_hot_and_move(spark, tmp_path, capsys):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    (folder / "input_1700000000000").write_text(
        '{"data":[{"p":1.5,"s":"A","t":1700000000000,"v":10},\n'
        '{"p":2.5,"s":"A","t":99999999999999,"v":20}],"type":"trade"}'
    )
    main(
        ["hot", "--messages", str(folder), "--store", store, "--once"]
        + ["--checkpoint", str(tmp_path / "checkpoint"), "--max-bytes", "1000000"]
    )
    assert TradeStore(spark, store).read_hot().count() == 2
    main(["move", "--store", store])
    assert "'moved': 1, 'left': 1" in capsys.readouterr().out
    assert rows(TradeStore(spark, store).read_cold(), "volume") == [(10,)]
    main(["compact", "--store", store])
    assert "'days': 0" in capsys.readouterr().out


def test_hot_reads_messages_a_line_each(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    line = '{"data":[{"p":1.5,"s":"A","t":%d,"v":10}],"type":"trade"}\n'
    (folder / "landed").write_text(line % 1 + line % 2)
    main(["hot", "--messages", str(folder), "--store", store, "--lines", "--once", "--checkpoint", str(tmp_path / "c")])
    assert TradeStore(spark, store).read_hot().count() == 2


def page(position, header, *lines):
    def table(tag, cells):
        return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"

    body = table("th", header) + "".join(table("td", line) for line in lines)
    return "<table><tr><td>x</td></tr></table>\n" * position + f"<table>{body}</table>"


def test_universe(spark, tmp_path):
    pages = {
        "S&P500": page(0, ["Symbol", "Security", "GICS Sector", "n"], ["MMM", "3M", "Ind", "1"]),
        "NASDAQ": page(
            4, ["Company", "Ticker", "GICS Sector"], ["Apple", "AAPL", "IT"], ["Tesla", "TSLA", "C"]
        ),
    }
    for index, text in pages.items():
        folder = tmp_path / "pages" / f"index={index}"
        folder.mkdir(parents=True)
        (folder / "page.html").write_text(text)
    main(["universe", "--pages", str(tmp_path / "pages"), "--out", str(tmp_path / "out")])
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [
        ("AAPL", "Apple", "IT", "NASDAQ"),
        ("MMM", "3M", "Ind", "S&P500"),
        ("TSLA", "Tesla", "C", "NASDAQ"),
    ]


def test_train_and_predict(spark, tmp_path, capsys):
    (tmp_path / "trading.csv").write_text("volume,price\n10,2.0\n10,4.0\n100,8.0\n")
    model = str(tmp_path / "model")
    main(["train", "--trades", str(tmp_path / "trading.csv"), "--model", model])
    main(["predict", "--model", model, "--volume", "10", "--volume", "1200", "--volume", "55"])
    assert capsys.readouterr().out.split("\n")[:3] == ["10 3.0", "1200 8.0", "55 3.0"]
