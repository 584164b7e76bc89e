"""Arguments of the public queries, with their bounds."""

from __future__ import annotations

from pydantic import BaseModel, ConfigDict, Field

_Period = Field(None, ge=1, le=10)
_Seconds = Field(None, ge=0)


class PlayQuery(BaseModel):
    """Arguments of a page of one contest's plays."""

    model_config = ConfigDict(extra="forbid")

    event_type: str | None = None
    period_number: int | None = _Period
    min_period: int | None = _Period
    max_period: int | None = _Period
    player_name: str | None = None
    team: str | None = None
    team_id: int | None = None
    possession_team_id: int | None = None
    max_period_seconds_remaining: int | None = _Seconds
    min_period_seconds_remaining: int | None = _Seconds
    max_game_seconds_remaining: int | None = _Seconds
    min_game_seconds_remaining: int | None = _Seconds
    shot_result: str | None = None
    shot_possession_retained: bool | None = None
    is_extra_man_opportunity: bool | None = None
    event_team_margin_min: int | None = None
    event_team_margin_max: int | None = None
    order_by: str = "play_seq"
    order_desc: bool = False
    limit: int = Field(100, ge=1, le=500)
    offset: int = Field(0, ge=0)


class PlayFilter(PlayQuery):
    """Arguments of a page of all plays."""

    contest_id: int | None = None
    event_types: list[str] | None = None
    home_score_margin_min: int | None = None
    home_score_margin_max: int | None = None


class ShootingQuery(BaseModel):
    """Arguments of the shooting summary."""

    model_config = ConfigDict(extra="forbid")

    min_player_shots: int = Field(10, ge=1)
    top_players_limit: int = Field(10, ge=1, le=100)
    top_teams_limit: int = Field(10, ge=1, le=100)
    contest_id: int | None = None
    order_by: str = Field("realized", pattern="^(realized|normalized)$")


def merged(base: dict | None, direct: dict) -> PlayFilter:
    """A filter whose directly given arguments go before those of base; the result is validated as a whole."""
    return PlayFilter(**{k: v for k, v in (base or {}).items()} | {k: v for k, v in direct.items() if v is not None})
