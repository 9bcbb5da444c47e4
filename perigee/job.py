"""Command line of the batch run, for spark-submit."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from perigee.plans.batch import BatchConfig, run_batch
from perigee.session import build_session, object_store_conf
from perigee.sinks.jdbc import JdbcTarget
from perigee.sources.raw import RAW_FORMATS


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    parser = argparse.ArgumentParser(description="Satellite telemetry batch run")
    parser.add_argument("--raw", required=True, help="URI of the raw datasets")
    parser.add_argument("--processed", required=True, help="URI for results")
    parser.add_argument("--checkpoint", help="shared checkpoint URI, unless the cluster names one")
    parser.add_argument("--format", default="csv", choices=RAW_FORMATS)
    parser.add_argument("--json-multi-line", action="store_true", help="read each JSON file by one task")
    parser.add_argument("--batch", help="name of the batch, as of a day, whose results are replaced; the others stay")
    parser.add_argument("--ordered", action="store_true", help="input is in order of its output folders")
    parser.add_argument(
        "--db-append-only", action="store_true", help="load without psycopg2, into a table that exists"
    )
    parser.add_argument("--db-host")
    parser.add_argument("--db-port", type=int, default=5432)
    parser.add_argument("--db-name", default="telemetry")
    parser.add_argument("--db-user")
    parser.add_argument("--db-password", default=env("DB_PASSWORD"))
    parser.add_argument("--s3-endpoint", default=env("S3_ENDPOINT_URL"))
    return parser.parse_args(argv)


def statement_runner(args: argparse.Namespace):
    """A function running one statement on the database; none if only appends are asked for."""
    if args.db_append_only:
        return None
    import psycopg2

    def execute(statement: str) -> None:
        connection = psycopg2.connect(
            host=args.db_host,
            port=args.db_port,
            dbname=args.db_name,
            user=args.db_user,
            password=args.db_password,
        )
        try:
            with connection, connection.cursor() as cursor:
                cursor.execute(statement)
        finally:
            connection.close()

    return execute


def database_of(args: argparse.Namespace) -> JdbcTarget | None:
    if not args.db_host:
        return None
    return JdbcTarget.postgres(
        args.db_host,
        args.db_name,
        args.db_port,
        user=args.db_user,
        password=args.db_password,
        execute=statement_runner(args),
    )


def session_conf(args: argparse.Namespace) -> dict[str, str]:
    conf = {}
    if any(str(uri).startswith("s3a:") for uri in (args.raw, args.processed, args.checkpoint)):
        conf |= object_store_conf(
            args.s3_endpoint, os.environ.get("S3_ACCESS_KEY"), os.environ.get("S3_SECRET_KEY")
        )
    if args.checkpoint:
        conf["spark.checkpoint.dir"] = args.checkpoint
    return conf


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("perigee-batch", session_conf(args))
    try:
        config = BatchConfig(
            args.raw,
            args.processed,
            args.format,
            args.json_multi_line,
            database_of(args),
            batch=args.batch,
            gather=not args.ordered,
        )
        run_batch(spark, config)
        return 0
    except Exception:  # noqa: BLE001 - the exit code reports it
        logging.exception("batch run failed")
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
