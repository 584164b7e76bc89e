"""The public endpoints without a web framework: a request in, a status and a body out.

Every request opens the generation that is current then and stays on it; all
fields of a graph query share it. Adapters for frameworks only have to pass
requests on; `asgi` is one that needs nothing but the standard library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path
from typing import Any
from urllib.parse import parse_qs

from pydantic import ValidationError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .graph import GraphError, Type, camel, execute, snake
from .params import PlayFilter, PlayQuery, ShootingQuery, merged
from .serving import Catalog, rows_of

Answer = tuple[int, Any]


def mirrored(play: dict[str, Any]) -> dict[str, Any]:
    """A play with event_team_id and team_id, either from the other."""
    team = play.get("team_id") if play.get("team_id") is not None else play.get("event_team_id")
    return play | {"team_id": team, "event_team_id": team}


class Api:
    """Dispatcher over one gold root."""

    def __init__(self, spark: SparkSession, gold_root: str | Path):
        self.spark, self.root = spark, gold_root
        self.routes: list[tuple[str, Callable[..., Answer]]] = [
            (r"/", lambda q: (200, {"service": "scorelake", "endpoints": [p for p, _ in self.routes]})),
            (r"/api/health", lambda q: (200, {"status": "ok"})),
            (r"/api/contests", lambda q: (200, rows_of(self.catalog().contests()))),
            (r"/api/contests/(\d+)/summary", self.summary),
            (r"/api/contests/(\d+)/plays", self.contest_plays),
            (r"/api/plays", self.plays),
            (r"/api/(?:shooting-efficiency|shooting_efficiency|efficiency)", self.shooting),
        ]

    def catalog(self) -> Catalog:
        return Catalog.open(self.spark, self.root)

    def summary(self, query: dict[str, Any], contest: str) -> Answer:
        found = rows_of(self.catalog().contest_summary(int(contest)))
        return (200, found[0]) if found else (404, {"detail": "there is no such contest"})

    def contest_plays(self, query: dict[str, Any], contest: str) -> Answer:
        wanted = PlayQuery(**query).model_dump(exclude_none=True)
        return 200, [mirrored(p) for p in rows_of(self.catalog().plays(contest_id=int(contest), **wanted))]

    def plays(self, query: dict[str, Any]) -> Answer:
        return 200, [mirrored(p) for p in rows_of(self.catalog().plays(**PlayFilter(**query).model_dump(exclude_none=True)))]

    def shooting(self, query: dict[str, Any]) -> Answer:
        wanted, catalog = ShootingQuery(**query), self.catalog()
        if wanted.contest_id is not None and not catalog.has_contest(wanted.contest_id):
            return 404, {"detail": "there is no such contest"}
        return 200, catalog.shooting_summary(**wanted.model_dump())

    def get(self, path: str, query: dict[str, Any] | None = None) -> Answer:
        """Answer a request: 404 for unknown paths, 422 for arguments out of their bounds."""
        for pattern, handler in self.routes:
            if match := re.fullmatch(pattern, path):
                try:
                    return handler(query or {}, *match.groups())
                except ValidationError as e:
                    return 422, {"detail": json.loads(e.json(include_url=False, include_context=False))}
        return 404, {"detail": "there is no such path"}

    def graph(self, document: str, variables: dict[str, Any] | None = None, operation: str | None = None) -> dict[str, Any]:
        """Answer a graph query; all its fields read one generation."""
        catalog = self.catalog()
        return execute(self.schema(catalog), document, variables, operation)

    def schema(self, catalog: Catalog) -> Type:
        """Contests with their team statistics, and plays by a filter over which direct arguments go."""
        columns = lambda name: tuple(getattr(catalog, name).columns)
        stats = Type("TeamStats", columns("agg_team_game_stats"))
        mine = lambda contest, _: rows_of(catalog.agg_team_game_stats.filter(F.col("contest_id") == contest["contest_id"]).orderBy("team_id"))
        contest = Type("Contest", columns("dim_contests"), {"teamStats": (stats, (), mine)})
        play = Type("Play", (*columns("fact_plays"), "event_team_id"))

        def one(_: Any, arguments: dict[str, Any]) -> dict[str, Any] | None:
            if not isinstance(arguments.get("id"), int):
                raise GraphError("contest needs an id")
            found = rows_of(catalog.dim_contests.filter(F.col("contest_id") == arguments["id"]).limit(1))
            return found[0] if found else None

        def plays(_: Any, arguments: dict[str, Any]) -> list[dict[str, Any]]:
            base = {snake(k): v for k, v in (arguments.pop("filter", None) or {}).items()}
            try:
                wanted = merged(base, arguments)
            except ValidationError as e:
                raise GraphError("; ".join(f"{'.'.join(map(str, x['loc']))}: {x['msg']}" for x in e.errors())) from None
            return [mirrored(p) for p in rows_of(catalog.plays(**wanted.model_dump(exclude_none=True)))]

        return Type("Query", (), {
            "contests": (contest, (), lambda _, __: rows_of(catalog.contests())),
            "contest": (contest, ("id",), one),
            "plays": (play, ("filter", *map(camel, PlayFilter.model_fields)), plays),
        })

    async def asgi(self, scope: dict[str, Any], receive: Callable, send: Callable) -> None:
        """An ASGI application that allows requests from any origin, also those that ask beforehand."""
        if scope["type"] != "http":
            return
        given = {k.decode().lower(): v.decode() for k, v in scope.get("headers", [])}
        origin = given.get("origin")
        headers = [(b"access-control-allow-origin", (origin or "*").encode()), (b"vary", b"Origin")] + ([(b"access-control-allow-credentials", b"true")] if origin else [])
        method = scope.get("method", "GET")
        if method == "OPTIONS":
            asked = given.get("access-control-request-headers", "*")
            headers += [(b"access-control-allow-methods", b"DELETE, GET, HEAD, OPTIONS, PATCH, POST, PUT"), (b"access-control-allow-headers", asked.encode()), (b"access-control-max-age", b"600")]
            await send({"type": "http.response.start", "status": 200, "headers": headers})
            await send({"type": "http.response.body", "body": b""})
            return
        raw = parse_qs(scope["query_string"].decode())
        query = {k: v if k == "event_types" else v[-1] for k, v in raw.items()}
        if scope["path"] == "/graphql":
            asked = query
            if method == "POST":
                body = b""
                while True:
                    message = await receive()
                    body += message.get("body", b"")
                    if not message.get("more_body"):
                        break
                try:
                    asked = json.loads(body)
                except ValueError:
                    asked = {}
            variables = asked.get("variables") or {}
            if "query" not in asked:
                status, answer = 400, {"errors": [{"message": "there is no query"}]}
            else:
                status, answer = 200, self.graph(asked["query"], json.loads(variables) if isinstance(variables, str) else variables, asked.get("operationName"))
        else:
            status, answer = self.get(scope["path"], query) if method in ("GET", "HEAD") else (405, {"detail": "only GET is answered here"})
        await send({"type": "http.response.start", "status": status, "headers": [(b"content-type", b"application/json"), *headers]})
        await send({"type": "http.response.body", "body": json.dumps(answer, default=str).encode()})
