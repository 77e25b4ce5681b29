import pytest
from pyspark.sql import functions as F

from tarmaq.plans import governance, refresh
from tarmaq.plans import vocabulary as V
from tarmaq.sources.lake import Lake
from tests.conftest import rows

FLIGHT = "{air};{number};0;N;{origin};{to};2025-08-{day:02d} 10:00:00;{left};" \
         "2025-08-{day:02d} 11:00:00;{came};{status};N/A"


def flown(number, air="AZU", origin="SBGR", to="SBSP", day=1, late=0):
    moment = f"2025-08-{day:02d} {{hour}}:{late:02d}:00"
    return FLIGHT.format(air=air, number=number, origin=origin, to=to, day=day, status="REALIZADO",
                         left=moment.format(hour="10"), came=moment.format(hour="11"))


def cancelled(number, **kw):
    return FLIGHT.format(air=kw.get("air", "AZU"), number=number, origin="SBGR", to="SBSP", day=2,
                         left="null", came="null", status="CANCELADO")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")

    def save(name, header, lines, encoding="utf-8"):
        text = "\n".join(["Atualizado em: 01/08/2025", header, *lines]) + "\n"
        (folder / name).write_text(text, encoding=encoding)

    header = ";".join(V.FLIGHT_COLUMNS)
    save("VRA_1.csv", header, [flown(1), flown(2, late=20), cancelled(3), flown(4, to="KJFK")])
    save("VRA_2.csv", header, [flown(1), flown(5, air="XXX", day=3), flown(6, origin="SBAA", day=4)])
    save("aero.csv", ";".join(V.AERODROME_COLUMNS), [
        'SBGR;SP1;Guarulhos "Cumbica;Guarulhos;SP;São Paulo;SP;23S;46W;750,5;ok',
        "SBSP;SP2;Congonhas;São Paulo;SP;São Paulo;SP;23S;46W;N/D;ok"], "iso-8859-1")
    companies = ";".join(V.COMPANY_COLUMNS)
    save("pda_empresas_aereas_nacionais.csv", companies, [
        "AZU;AD;Azul;Regular;Barueri;SP;ATIVA", ";;Sem codigo;;;;INATIVA"])
    save("pda_empresas_aereas_estrangeiros.csv", companies, ["TAP;TP;TAP;Regular;Lisboa;;ATIVA"])
    built = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    inputs = refresh.Inputs(f"{folder}/VRA_*.csv", f"{folder}/aero.csv", str(folder))
    built.first_run = refresh.refresh(built, inputs)
    built.second_run = refresh.refresh(built, inputs)
    return built


def test_refresh_is_repeatable(lake):
    assert lake.first_run == lake.second_run
    for name in ["silver.vra_quarentena", "gold.obt_flights"]:
        clocks = ["_ingerido_em", "_transformed_at", "_quarentenado_em", "_processed_at"]
        first, second = (lake.read(name, v).drop(*clocks) for v in (0, 1))
        assert rows(first) == rows(second)
    assert rows(lake.history("gold.obt_flights").select("rows_written")) == [(6,), (6,)]


def test_rule_counts_are_observed(lake):
    failed = {name: n for name, n in lake.second_run.items() if n}
    assert failed == {"rows": 7, V.RULE_NAMES[6]: 1, V.RULE_NAMES[7]: 1, V.RULE_NAMES[8]: 1}
    assert lake.read("silver.vra_quarentena").count() == 3


def test_chain(lake):
    assert rows(refresh.chain_report(lake, accepted_copies=1)) == [
        ("bronze.vra -> silver.vra", 7, 7, 0, 0, "OK"),
        ("gold.fact_flights -> gold.obt_flights", 6, 6, 0, 0, "OK"),
        ("silver.vra -> gold.fact_flights", 7, 6, 1, 1, "OK")]


def test_tables_answer_sql_by_name(spark, lake):
    found = spark.sql("""
        SELECT airline_name, count(*) AS flights, sum(CAST(flight_cancelled AS INT)) AS cancelled
        FROM gold.obt_flights GROUP BY airline_name ORDER BY airline_name""")
    assert rows(found) == [("Azul", 5, 1), ("COMPANHIA NAO CADASTRADA (XXX)", 1, 0)]
    assert rows(spark.table("silver.aerodromes").select("name", "altitude_m")) == [
        ("Congonhas", None), ('Guarulhos "Cumbica', 750.5)]


def test_everything_is_documented_tagged_and_traceable(lake):
    covered = governance.documentation_coverage(lake)
    assert covered.count() == 13 and covered.where("missing > 0").count() == 0
    assert governance.undocumented_columns(lake).count() == 0
    assert governance.tables_without_tag(lake, "gold", "grain").count() == 0
    assert governance.tables_without_tag(lake, "silver", "owner").count() == 5
    assert governance.tag_listing(lake).count() == 39
    edges = rows(governance.recent_lineage(lake))
    assert ("(file)", "bronze.vra") in edges
    assert ("gold.dim_airport", "gold.obt_flights") in edges
    assert len(edges) == 20
    assert governance.row_count_report(lake).where(F.col("rows").isNull()).count() == 0


def test_names_carry_comments_and_answer_while_they_are_replaced(spark, lake):
    described = spark.sql("DESCRIBE gold.obt_flights").collect()
    assert all(r["comment"] for r in described)
    before = spark.table("gold.dim_airport").count()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        lake.write("gold.dim_airport", spark.range(3).select(
            F.expr("1 / (id - id)").alias("x")))
    assert spark.table("gold.dim_airport").count() == before


def test_a_partial_run_logs_its_own_edges(spark, tmp_path):
    small = Lake(spark, str(tmp_path))
    small.build("part_a.one", lambda: spark.range(3))
    small.build("part_b.two", lambda one: one.where("id > 0"), "part_a.one")
    log = small.read_appended("audit.run_log")
    assert rows(log.select("source", "target")) == [
        ("", "part_a.one"), ("part_a.one", "part_b.two")]
    assert spark.table("part_b.two").count() == 2


def test_validation_report_and_kept_counts(lake):
    report = {r["check"]: r["verdict"] for r in governance.validation_report(lake, 1).collect()}
    assert len(report) == 6 and set(report.values()) == {"OK"}
    strict = governance.validation_report(lake, 0).where("verdict = 'CHECK'").collect()
    assert [r["found"] for r in strict] == [1]
    kept = lake.read_appended("audit.expectations")
    assert kept.count() == 2 * len(V.RULE_NAMES)
    assert kept.select("checked_at").distinct().count() == 2
    assert rows(kept.groupBy("rows").agg(F.sum("failed"))) == [(7, 6)]
