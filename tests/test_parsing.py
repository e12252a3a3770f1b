from pyspark.sql import functions as F

from meterflow.operators.parsing import parse_telegram_lines, with_validity


def parse(spark, telegrams):
    rows = [(t, i, l) for t, lines in telegrams.items() for i, l in enumerate(lines)]
    df = spark.createDataFrame(rows, "t string, line_no long, line string")
    out = with_validity(parse_telegram_lines(df, ["t"], ["line_no"], keep_dst_flag=True)).collect()
    return {r.t: r for r in out}


def test_fields_and_edges(spark):
    r = parse(spark, {
        "full": ["/SYN5", "0-0:1.0.0(240101000007S)", "1-0:1.8.1(000123.456*kWh)", "1-0:1.8.2(000000.010*kWh)",
                 "1-0:2.8.1(000001.000*kWh)", "1-0:2.8.2(000006.550*kWh)", "0-0:96.14.0(0002)",
                 "1-0:1.7.0(000006.550*kW)", "1-0:2.7.0(000000.001*kW)",
                 "0-1:24.2.1(240101000000W)(000006.550*m3)", "!0000"],
        "repeat": ["0-0:1.0.0(240101000007W)", "1-0:1.7.0(000001.000*kW)", "1-0:1.7.0(000002.000*kW)"],
        "missing_ts": ["1-0:1.8.1(000001.000*kWh)"],
        "bad_decimals": ["0-0:1.0.0(240101000007W)", "1-0:1.8.1(000001.00*kWh)", "1-0:1.8.2(1.2345*kWh)"],
        "trailing": ["0-0:1.0.0(240101000007W)junk", "1-0:1.8.1(000001.000*kWh) more"],
        "not_anchored": ["x0-0:1.0.0(240101000007W)", "0-0:1.0.0(24010100000W)"],
    })
    f = r["full"]
    assert f.timestamp == "240101000007" and f.dstFlag == "S"
    assert (f.electricityConsumption1, f.electricityConsumption2) == (123.456, 0.01)
    assert (f.electricityProduction1, f.electricityProduction2) == (1.0, 6.55)
    assert (f.currentTariff, f.currentConsumption, f.currentProduction) == (2, 6.55, 0.001)
    assert (f.gasTimestamp, f.gasConsumption) == ("240101000000", 6.55) and f.valid
    assert r["repeat"].currentConsumption == 2.0
    assert r["repeat"].gasTimestamp == "" and r["repeat"].gasConsumption == 0.0 and r["repeat"].currentTariff == 0
    assert not r["missing_ts"].valid and r["missing_ts"].reason == "missing_timestamp"
    assert r["bad_decimals"].electricityConsumption1 == 0.0 and r["bad_decimals"].electricityConsumption2 == 0.0
    assert r["trailing"].valid and r["trailing"].electricityConsumption1 == 1.0
    assert not r["not_anchored"].valid
