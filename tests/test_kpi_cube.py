import random
from datetime import datetime, timedelta

import pytest

from telar.operators import kpi_cube, state

SCHEMA = "id long, descripcion string, descripcion_contrato string, estado string, fecha_publica timestamp, fecha_fin_cotizacion timestamp, categoria_it string, relevancia_ia string"
ORDER = ["estado", "descripcion", "descripcion_contrato", "categoria_it", "relevancia_ia", "fecha_publica", "fecha_fin_cotizacion"]
DAY = datetime(2024, 5, 10, 12)


def record(rng, key):
    when = lambda: rng.choice([None, DAY + timedelta(hours=rng.randint(-24 * 15, 24 * 9))])
    return (
        key, rng.choice(["red OT de agua", "Integración y gpt", "compra", None]), rng.choice(["telemetria", "x", None]), rng.choice([state.OPEN, state.OPEN, state.EVALUATED, state.CLOSED, None]),
        when(), when(), rng.choice(["IA/analytics", "Cloud/hosting", "Oracle", "", None]), rng.choice(["ALTA", "BAJA", "", None]),
    )


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_twenty_random_batches(spark, one_partition):
    """After each batch the cube gives what the full scan gives, on another day each time."""
    rng = random.Random(5)
    frame = lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema).coalesce(1)
    rows = {k: record(rng, k) for k in range(40)}
    counts = kpi_cube.cube(frame(list(rows.values())))
    for step in range(20):
        contracts, counts = frame(list(rows.values())), frame([tuple(r) for r in counts.collect()], counts.schema)
        if step % 4 == 3:
            gone = rng.sample(sorted(rows), 6)
            _, counts = kpi_cube.deleted(contracts, frame([(k,) for k in [*gone, 999]], "id long"), counts)
            rows = {k: v for k, v in rows.items() if k not in gone}
        else:
            batch = [record(rng, rng.randrange(70)) for _ in range(12)]
            _, counts = kpi_cube.upserted(contracts, frame(batch), counts, ORDER)
            batch.sort(key=lambda r: tuple((x is not None, x if x is not None else "") for x in (r[3], r[1], r[2], r[6], r[7], r[4], r[5])))
            rows |= {r[0]: r for r in reversed(batch)}
        as_of = (DAY + timedelta(days=rng.randint(-3, 3))).isoformat()
        full = frame(list(rows.values()))
        both = kpi_cube.kpis(counts, as_of).unionByName(state.kpis(full, as_of)).collect()
        assert both[0] == both[1]
        if step % 5 == 0:
            both = kpi_cube.business_kpis(counts, as_of).unionByName(state.business_kpis(full, as_of)).collect()
            assert both[0] == both[1]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert kpi_cube.cube(none).count() == 0
    got = kpi_cube.kpis(kpi_cube.cube(none), DAY.isoformat()).first()
    assert got == state.kpis(none, DAY.isoformat()).first()
    assert (got.total_postulables, got.por_linea) == (0, "[]")
