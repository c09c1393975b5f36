"""Command line of the load, for ``spark-submit`` or ``python -m starquay``."""

from __future__ import annotations

import argparse

from starquay.plans.load import check, full_load, read_raw, read_unseen, refresh, tables_of
from starquay.session import build_session, listed_bytes, size_shuffles
from starquay.sources.ledger import list_files
from starquay.sources.versions import remove_old
from starquay.staging import discard


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starquay", description=__doc__)
    parser.add_argument("--arrivals", help="glob of the arrival files")
    parser.add_argument("--arrivals-format", default="parquet")
    parser.add_argument("--arrivals-fallback", help="Parquet directory to read instead")
    parser.add_argument("--temperature", help="CSV of temperatures by city")
    parser.add_argument("--demographics", help="CSV of city demographics, with ;")
    parser.add_argument("--labels", help="label text, or a glob of them")
    parser.add_argument("--output", required=True, help="root of the stored tables")
    parser.add_argument("--append", action="store_true", help="read only new files, and keep what is stored")
    parser.add_argument("--keep-versions", type=int, default=2, help="versions of the tables to keep")
    parser.add_argument("--input-bytes", type=int, help="size of the input, if not as listed, to size shuffles")
    parser.add_argument("--sparse-columns", help="comma-separated columns of the arrivals to leave out")
    options = parser.parse_args(arguments)

    spark = build_session()
    named = ("arrivals", "temperature", "demographics", "labels")
    paths = {name: path for name in named if (path := getattr(options, name))}
    sparse = options.sparse_columns.split(",") if options.sparse_columns is not None else None
    try:
        if options.append:
            raw, files = read_unseen(spark, options.output, paths, options.arrivals_format)
        else:
            raw = read_raw(
                spark,
                **paths,
                arrivals_format=options.arrivals_format,
                arrivals_fallback=options.arrivals_fallback,
            )
            files = list_files(spark, paths)
        given = [df for df in vars(raw).values() if df is not None]
        size_shuffles(spark, options.input_bytes or listed_bytes(given))
        if options.append and files is not None:
            refresh(spark, raw, options.output, sparse, files)
        elif not options.append:
            full_load(raw, options.output, sparse, files)
        remove_old(spark, options.output, options.keep_versions)
        if given:
            check(spark, options.output, tables_of(raw)).show()
        else:
            print("no new files")
    finally:
        discard(spark)


if __name__ == "__main__":
    main()
