"""Runs one step of the daily job: ``python -m gradeline ingest --folder ... --landing ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from gradeline.plans import daily
from gradeline.session import get_session

STEPS = ("ingest", "clean", "aggregate", "freeze", "ask", "record", "score", "check")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gradeline", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--folder", required=True, help="shared folder of the tables")
    parser.add_argument("--landing", help="folder of the landing files (ingest)")
    parser.add_argument("--layer", choices=["bronze", "silver", "gold", "predictions"], help="layer to check")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="day of the calls (ask); today by default")
    parser.add_argument("--backfill-start", type=dt.date.fromisoformat, help="first day of a backfill (ask)")
    parser.add_argument("--use-rag", default="", help="true or false for one variant (ask)")
    parser.add_argument("--model", default="", help="empty or big (ask)")
    parser.add_argument("--embeddings", help="Parquet of (doc_id, embedding) (ask)")
    parser.add_argument("--questions", help="Parquet of (entity, query_text, query_vector) (ask)")
    parser.add_argument("--prompts", help="Parquet of prompts: written by ask, read by record")
    parser.add_argument("--replies", help="Parquet of replies (record)")
    parser.add_argument("--endpoint", default="", help="name of the model that replied (record)")
    args = parser.parse_args(argv)

    spark = get_session()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    wh = daily.Warehouse.at(spark, args.folder)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def parquet(path: str | None):
        return spark.read.parquet(path) if path else None

    if args.step == "ingest":
        daily.ingest(wh, args.landing, now)
    elif args.step == "clean":
        daily.clean(wh)
    elif args.step == "aggregate":
        daily.aggregate(wh)
    elif args.step == "freeze":
        daily.freeze_cutoffs(wh, now)
    elif args.step == "ask":
        prompts = daily.ask(
            wh, args.as_of or now.date(), args.backfill_start, args.use_rag, args.model,
            parquet(args.embeddings), parquet(args.questions),
        )
        prompts.write.parquet(args.prompts)
    elif args.step == "record":
        daily.record(wh, parquet(args.prompts), parquet(args.replies), args.endpoint, now)
    elif args.step == "score":
        daily.score(wh)
    else:
        daily.check(wh, args.layer, now)


if __name__ == "__main__":
    main()
