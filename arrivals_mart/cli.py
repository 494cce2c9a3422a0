"""Command line: ``spark-submit arrivals_mart/cli.py <command> ...``.

``run``    the whole run: 7 tables staged, checked, published; prints the
           table paths as JSON.
``table``  one table from its own inputs, staged below the output and checked
           (what each separate job of a split schedule does).
``ask``    one of the three questions over written tables, shown or written.

Paths are any Hadoop URI and may hold ``{name}`` placeholders filled from
``--param name=value``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arrivals_mart.contracts import BY_NAME  # noqa: E402


def _params(pairs: list[str]) -> dict[str, str]:
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        out[key] = value
    return out


#: Inputs whose file name (or glob, below --input) may be given.
INPUT_NAMES = ("arrivals", "airports", "demographics", "temperatures", "countries")


def _input_flags(p: argparse.ArgumentParser) -> None:
    p.add_argument("--input", required=True)
    for name in INPUT_NAMES:
        p.add_argument(f"--{name}", help=f"file name or glob of the {name} below --input")


def _names(args: argparse.Namespace) -> dict[str, str]:
    return {n: getattr(args, n) for n in INPUT_NAMES if getattr(args, n)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="arrivals_mart")
    p.add_argument("--master", help="only outside spark-submit, e.g. local[8]")
    p.add_argument("--hive", action="store_true", help="use a Hive catalog, so that published views last")
    sub = p.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="build, check and publish all seven tables")
    _input_flags(run)
    run.add_argument("--output", required=True)
    run.add_argument("--param", action="append", default=[])
    run.add_argument("--no-publish", action="store_true")
    run.add_argument("--full-report", action="store_true", help="also duplicate keys, rows left out, lost values")
    run.add_argument("--unique", action="append", default=[], choices=sorted(BY_NAME),
                     help="a table whose key must not repeat")
    run.add_argument("--reject", action="store_true",
                     help="rows without a key go to a rejects table instead of failing the run")
    run.add_argument("--keep", type=int, help="delete all but the newest N versions of each table afterwards")

    table = sub.add_parser("table", help="build and write one table")
    table.add_argument("name", choices=sorted(BY_NAME))
    _input_flags(table)
    table.add_argument("--output", required=True)
    table.add_argument("--param", action="append", default=[])
    table.add_argument("--mode", default="stage", choices=["stage", "append", "load"],
                       help="a checked new version below --output, checked rows added to the table at --output, or "
                            "a checked load whose key may not repeat in it or in earlier loads below --output")

    ask = sub.add_parser("ask", help="answer a question over written tables")
    ask.add_argument("question", choices=["airport-month", "country-temperature", "state-population"])
    ask.add_argument("--fact", required=True)
    ask.add_argument("--time-dim")
    ask.add_argument("--airport-dim")
    ask.add_argument("--country-dim")
    ask.add_argument("--demographics-dim")
    ask.add_argument("--airport")
    ask.add_argument("--year", type=int)
    ask.add_argument("--month", type=int)
    ask.add_argument("--by", default="i94_resident", choices=["i94_resident", "i94_citizen"])
    ask.add_argument("--rows", type=int, default=50, help="rows of the answer to show")
    ask.add_argument("--write", help="write the answer as Parquet here instead of showing it")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    from arrivals_mart.plans import (
        arrivals_by_airport_month,
        arrivals_country_temperature,
        arrivals_state_population,
        build_table,
        read_inputs,
        run_pipeline,
        stage_table,
    )
    from arrivals_mart.operators import check_report
    from arrivals_mart.plans.pipeline import BUILDERS
    from arrivals_mart.session import build_session, scratch_path
    from arrivals_mart.sinks import (
        append_load,
        expire_manifests,
        expire_versions,
        manifests,
        read_manifest,
        read_table,
        render_path,
        write_table,
    )
    from arrivals_mart.sinks.tables import remove_path

    args = parser().parse_args(argv)
    hive = {"spark.sql.catalogImplementation": "hive"} if args.hive else None
    spark = spark or build_session(master=args.master, conf=hive)

    if args.command == "run":
        params = _params(args.param)
        inputs = read_inputs(spark, args.input, params=params, **_names(args))
        result = run_pipeline(
            spark,
            inputs,
            args.output,
            publish_views=not args.no_publish,
            params=params,
            full_report=args.full_report,
            unique=args.unique,
            reject=args.reject,
            manifest=not args.no_publish,
        )
        out = {"paths": result.paths, "manifest": result.manifest, "report": [r.asDict() for r in result.report]}
        if args.keep:
            root = render_path(args.output, **params)
            expire_manifests(spark, root, args.keep)
            spare = [p for m in manifests(spark, root) for p in read_manifest(spark, root, m).paths.values()]
            out["expired"] = [p for name in BY_NAME for p in expire_versions(spark, root, name, args.keep, spare)]
    elif args.command == "table":
        params = _params(args.param)
        inputs = read_inputs(spark, args.input, params=params, only=BUILDERS[args.name][0], **_names(args))
        df, contract, target = build_table(args.name, inputs), BY_NAME[args.name], render_path(args.output, **params)
        if args.mode == "load":
            done = append_load(spark, df, target, contract)
            out = {"paths": {args.name: done.path}, "load": done.name, "rows": done.row_count}
            print(json.dumps(out))
            return out
        append = args.mode == "append"
        path, row = stage_table(df, contract, scratch_path(spark, "append") if append else target)
        check_report([row])
        if append:
            # Checked where nobody reads it; then its rows are added.
            staged, path = path, target
            write_table(read_table(spark, staged, contract), target, contract, mode="append")
            remove_path(spark, staged)
        out = {"paths": {args.name: path}, "report": [row.asDict()]}
    else:
        def table(path, name, flag):
            if not path:
                raise SystemExit(f"--{flag} is needed for this question")
            return read_table(spark, path, BY_NAME[name])

        fact = table(args.fact, "immig_fact", "fact")
        if args.question == "airport-month":
            answer = arrivals_by_airport_month(
                fact,
                table(args.time_dim, "time_dim", "time-dim"),
                table(args.airport_dim, "airport_dim", "airport-dim"),
                airport_code=args.airport,
                year=args.year,
                month=args.month,
            )
        elif args.question == "country-temperature":
            answer = arrivals_country_temperature(
                fact, table(args.country_dim, "country_temperature_dim", "country-dim"), by=args.by
            )
        else:
            answer = arrivals_state_population(
                fact, table(args.demographics_dim, "demographics_dim", "demographics-dim")
            )
        if args.write:
            answer.write.mode("overwrite").parquet(args.write)
            out = {"paths": {"answer": args.write}}
        else:
            answer = answer.persist()
            total = answer.count()
            answer.show(args.rows, truncate=False)
            print(f"{min(args.rows, total)} of {total} rows shown (--rows, or --write for all)")
            answer.unpersist()
            out = {}
    if out:
        print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
