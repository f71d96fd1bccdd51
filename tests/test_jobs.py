import pytest

from vitrina import jobs
from vitrina.operators.compare import same_rows
from vitrina.plans.cleaning import clean_catalog
from vitrina.registry.catalogs import ORDER_SPEC, orders_raw
from vitrina.spec import CatalogSpec

SF = "/root/testdata/sf0.001"


def run(spark, job, **options):
    arguments = [job]
    for name, value in options.items():
        arguments += [f"--{name}", *(value if isinstance(value, list) else [str(value)])]
    jobs.JOBS[job](spark, jobs.parse(arguments), CatalogSpec())


def test_jobs_end_to_end(spark, tmp_path, capsys):
    raw, clean = tmp_path / "raw.parquet", tmp_path / "clean.parquet"
    orders_raw(spark, SF).write.parquet(str(raw))
    run(spark, "clean", input=raw, output=clean)
    expected = clean_catalog(orders_raw(spark, SF), ORDER_SPEC)
    assert same_rows(spark.read.parquet(str(clean)), expected)

    run(spark, "queries", input=clean, output=tmp_path / "suite")
    run(spark, "compare", input=tmp_path / "suite", engines=[f"again={tmp_path / 'suite'}"])
    assert "again|10" in capsys.readouterr().out.replace(" ", "")

    run(spark, "changes", input=clean, output=tmp_path / "copy", rows=100)
    stages = spark.read.option("header", True).csv(str(tmp_path / "copy" / "resumen")).collect()
    assert [(row.etapa, row.filas, row.coincidencias) for row in stages] == [
        ("00_antes", "100", "0"),
        ("01_create", "101", "1"),
        ("02_read", "101", "1"),
        ("03_update", "101", "1"),
        ("04_delete", "100", "0"),
    ]
    with pytest.raises(RuntimeError, match="filas"):
        run(spark, "gate", input=clean)


def test_reports_say_what_is_not_shown_and_write_everything(spark, tmp_path, capsys):
    rows = [(key, None if key < 150 else f"same{key % 3}", f"n{key}") for key in range(400)]
    clean = tmp_path / "clean.parquet"
    spark.createDataFrame(rows, "id long, slug string, name string").write.parquet(str(clean))
    run(spark, "collisions", input=clean, output=tmp_path / "reports")
    out = capsys.readouterr().out
    assert "without_slug: 50 more rows are not shown" in out
    written = spark.read.parquet(str(tmp_path / "reports" / "without_slug"))
    assert written.count() == 150


def test_issues_of_reordered_broken_and_short_engines(spark, tmp_path):
    from vitrina.plans import suite
    from vitrina.plans.contract import CONTRACT
    from vitrina.registry.catalogs import orders_clean
    from vitrina.sources.writers import write_report

    clean = orders_clean(spark, SF)
    suite.write_suite(clean, ORDER_SPEC, str(tmp_path / "expected"))
    results = {name: query(clean, ORDER_SPEC) for name, query in CONTRACT.items()}
    changes = {
        "reordered": lambda name, df: df.orderBy("release_year", ascending=False) if name == "q02" else df,
        "broken": lambda name, df: df.selectExpr("genres", "videojuegos + 1 AS videojuegos") if name == "q03" else df,
        "short": lambda name, df: df.limit(5) if name == "q04" else df,
        "unordered": lambda name, df: df.withColumnRenamed("release_year", "anio") if name == "q10" else df,
    }
    for engine, change in changes.items():
        for name, df in results.items():
            write_report(change(name, df), str(tmp_path / engine / name))
    engines = {engine: str(tmp_path / engine) for engine in changes}
    outcomes = {
        (row.motor, row.query_id): (row.diferencias > 0, row.en_orden)
        for row in suite.compare_suites(spark, str(tmp_path / "expected"), engines).collect()
    }
    wrong = {key: value for key, value in outcomes.items() if value != (False, True)}
    assert len(outcomes) == 40
    assert wrong == {
        ("reordered", "q02"): (True, False), ("broken", "q03"): (True, True),
        ("short", "q04"): (True, True), ("unordered", "q10"): (True, False),
    }
    issues = {
        (row.motor, row.columna): row
        for row in suite.suite_issues(spark, str(tmp_path / "expected"), engines).collect()
    }
    first = results["q03"].first()
    row = issues["broken", "videojuegos"]
    assert (row.posicion, row.problema, float(row.esperado) + 1) == (0, "valor", float(row.actual))
    assert float(row.esperado) == first.videojuegos
    assert (issues["short", "platforms"].posicion, issues["short", "platforms"].problema) == (5, "falta")
    assert issues["unordered", "anio"].problema == "sobra"


@pytest.mark.parametrize("job", ["inspect", "profile", "values"])
def test_reports_run_on_raw_catalogs(spark, tmp_path, job, capsys):
    raw = tmp_path / "raw.parquet"
    orders_raw(spark, SF).write.parquet(str(raw))
    run(spark, job, input=raw)
    assert "genres" in capsys.readouterr().out


def test_words_and_timings(spark, tmp_path, capsys):
    text = tmp_path / "words.txt"
    text.write_text("a bb\nccc dddd\n", encoding="utf-8")
    run(spark, "words", input=text)
    times = tmp_path / "times.csv"
    times.write_text('query_id,seconds\nq01,"1,5"\nq02,2.5\n', encoding="utf-8")
    run(spark, "timings", engines=[f"one={times}"], output=tmp_path / "rollup")
    out = capsys.readouterr().out.replace(" ", "")
    assert "|4|10|2.5|2.5|" in out and "|one|4.0|1.0|" in out


def test_timings_take_the_last_total_of_a_log(spark, tmp_path, capsys):
    log, times = tmp_path / "run.log", tmp_path / "times.csv"
    log.write_text("Tiempo total consultas: 9.0 segundos\nTiempo total consultas: 3.0 segundos\n")
    times.write_text("query_id,seconds\nq01,6.0\n", encoding="utf-8")
    run(spark, "timings", engines=[f"one={times}", f"two={times}"], logs=[f"two={log}"])
    out = capsys.readouterr().out.replace(" ", "")
    assert "|one|6.0|2.0|reporte|" in out and "|two|3.0|1.0|registro|" in out
