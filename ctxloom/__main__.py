"""``python -m ctxloom``: queries over a store as JSON lines, its relations, and publication requests.

query --root R --environment E --domain D --sql S
relations --root R --environment E --domain D
publish --root R --environment E --domain D --request FILE [--contract FILE] [--model ID]
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from .functions.schema import json_safe
from .operators import resolve
from .plans import lifecycle
from .plans.engine import Engine
from .session import session
from .sources.store import Store


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ctxloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, own in (("query", ("sql",)), ("relations", ()), ("publish", ("request",))):
        p = commands.add_parser(name)
        for option in ("root", "environment", "domain", *own):
            p.add_argument(f"--{option}", required=True)
        if name == "publish":
            p.add_argument("--contract")
            p.add_argument("--model", default="context-model")
    args = parser.parse_args(argv)
    store = Store(session(), args.root, args.environment, args.domain)
    if args.command == "relations":
        print("\n".join(store.names()))
    elif args.command == "publish":
        declared = [json.loads(Path(args.contract).read_text())] if args.contract else []
        contract = resolve.resolved_contract(declared, model=args.model)
        done = lifecycle.publish_request(store.spark, store, json.loads(Path(args.request).read_text()), contract, {"context_model_id": args.model, "context_model_identity": args.model})
        print(json.dumps(done, sort_keys=True))
        return 0 if done["published"] else 1
    else:
        result = Engine(store.spark, {n: store.read(n) for n in store.names()}).sql(args.sql)
        for row in result.toLocalIterator():
            print(json.dumps(json_safe(row)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
