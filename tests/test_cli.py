"""The command line bootstraps from seed files and runs the pending dates."""

from __future__ import annotations

import json

from test_daily import DAYS, build_landing, write

from cardwatch import config
from cardwatch.__main__ import main
from cardwatch.plans import daily


def test_cli_bootstrap_and_run(spark, capsys):
    landing = config.scratch_path(spark, "cli-landing")
    seeds = config.scratch_path(spark, "cli-seeds")
    build_landing(landing)
    write(f"{seeds}/cards.csv", "card_num;account;create_dt;update_dt\n"
          "C1;AC1;1900-01-01;\nC2;AC2;1900-01-01;\nC3;AC3;1900-01-01;\n")
    write(f"{seeds}/accounts.csv", "account;valid_to;client;create_dt;update_dt\n"
          "AC1;2021-01-29;11;1900-01-01;\nAC2;2030-01-01;VIP-22;1900-01-01;\n"
          "AC3;2030-01-01;33;1900-01-01;\n")
    write(f"{seeds}/clients.csv",
          "client_id;last_name;first_name;patronymic;date_of_birth;passport_num;"
          "passport_valid_to;phone;create_dt;update_dt\n"
          "11;Ivanov;Ivan;Ivanovich;1970-01-01;9999 000011;;+7 1;1900-01-01;\n"
          "VIP-22;Petrov;Petr;Petrovich;1980-01-01;9999 000022;2040-01-01;+7 2;1900-01-01;\n"
          "33;Sidorov;Sidor;Sidorovich;1990-01-01;9999 000003;;+7 3;1900-01-01;\n")
    wh = config.scratch_path(spark, "cli-warehouse")
    assert main(["--warehouse", wh, "--landing", landing, "--seeds", seeds,
                 "--max-days", "1"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r["date"] for r in out] == [str(DAYS[0])]
    assert out[0]["hits"] == {"ACCOUNT": 1}
    assert main(["--warehouse", wh, "--landing", landing]) == 0
    assert daily.ledger(spark, daily.Warehouse(wh)).count() == 3
    clients = spark.read.parquet(daily.Warehouse(wh).clients)
    assert clients.filter("client_id = 'VIP-22'").count() == 1
