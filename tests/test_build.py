import json

from matchloom.plans.build import build
from matchloom.plans.cli import main, predict
from matchloom.sources import tables as S
from matchloom.sources.versions import read_version

HEAD = ["Матчи турнира Кубок весны", "Место проведения", "Город, Корты", "Возрастная группа", "до 15 лет", "01.02.2025 - 09.02.2025", "№", "Участник 1", "Участник 2", "Счет", "Этап"]


def page(records):
    cells = HEAD + [x for i, (a, b, score, sets, day) in enumerate(records) for x in (str(i + 1), a, b, score, sets, "ОТ", "Дата", day)]
    return "<html><script>x</script>" + "".join(f"<div>{c}</div>" for c in cells) + "<p>2026 ©</p></html>"


def test_pages_and_rankings_to_a_prediction(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    games = [("Иванова А.Б.", "Петрова В.Г.", "2-0", "6-1,6-2", f"{d:02d}.02.2025") for d in (2, 4)] + [("Петрова В.Г.", "Сидорова Д.Е.", "2-1", "6-1,3-6,[10-7]", "05.02.2025"), ("Иванова А.Б.", "Сидорова Д.Е.", "0:2", "1-6,2-6", "06.02.2025"), ("Никто Н.Н.", "Иванова А.Б.", "2-0", "6-0,6-0", "07.02.2025"), ("Иванова А.Б.", "Петрова В.Г.", "1-1", "6-1,1-6", "08.02.2025")]
    (tmp_path / "pages" / "tour_1.html").write_text(page(games))
    (tmp_path / "pages" / "tour_2.html").write_text(page(games[:1]))
    people = {"11": "Иванова Анна Борисовна", "22": "Петрова Вера Глебовна", "33": "Сидорова Дарья Егоровна"}
    lines = ["place,fio,rni,points,counting_tournaments,age_group_filter,ranking_date"]
    lines += [f"{i + 1},{name},{rni},{100 - 10 * i},4,до 15 лет,01.0{m}.2025" for m in (1, 2) for i, (rni, name) in enumerate(people.items())]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    book, where = str(tmp_path / "book"), {"pages": str(tmp_path / "pages"), "rankings": str(tmp_path / "r.csv")}
    assert build(spark, book, check_only=True, **where) == {"matches": "ready", "rankings": "ready", "dataset": "ready", "training": "ready"}
    assert build(spark, book, skip=("training",), **where)["dataset"] == "done"
    kept = S.read_sheet(spark, book, "matches_enriched")
    assert kept.count() == 5 and kept.where("player1_points_pre = 100 and player1_rank_pre = 1").count() == 3
    assert S.read_sheet(spark, book, "dropped_invalid").count() == 1 and S.read_sheet(spark, book, "dropped_duplicates").count() == 2
    assert S.read_sheet(spark, book, "matches").count() == 4 and S.read_sheet(spark, book, "players_without_rating").count() == 1
    assert S.read_sheet(spark, book, "age_group_check").where("not age_group_match").count() == 0
    out = predict(spark, book, "Иванова Анна Борисовна", "Петрова Вера Глебовна", "2025-03-01")
    assert len(out["head_to_head"]) == 2 and [r["common_id"] for r in out["common_opponents"]] == ["33"]
    (tmp_path / "old.csv").write_text("id,name,date\n7,Cup,1/2/2025\n7,Cup,1/2/2025\n,x,\n")
    assert main(["bootstrap", "--source", str(tmp_path / "old.csv"), "--output", str(tmp_path / "m")]) == 0
    assert json.loads(capsys.readouterr().out) == {"master": 1} and str(read_version(spark, str(tmp_path / "m" / "master")).first().start_date) == "2025-02-01"
    assert main(["status", "--tables", book, "--write-manifest"]) == 0
    assert json.loads(spark.read.text(f"{book}/manifest").first().value)["matches"]["rows"] == 4
