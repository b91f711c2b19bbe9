"""The seven marine layers and how each one's fact is built."""

from __future__ import annotations

from dataclasses import dataclass

from catchlake import constants as C


@dataclass(frozen=True)
class Layer:
    """main and sub are summary columns, or a number for a constant.

    area_keys are the fact columns that find the area, among the areas of area_layer. With allowed, the main area must be in
    the list of allowed areas.
    """

    name: str
    layer_id: int
    main: str | int
    sub: str | int
    area_keys: tuple[str, ...]
    area_layer: int
    discard_rule: bool = True
    end_use_price: bool = True
    score: str = "lookup"
    gear_join: bool = False
    allowed: bool = False


MAIN, SUB = "main_area_id", "sub_area_id"

LAYERS = {
    layer.name: layer
    for layer in (
        Layer("eez", C.EEZ, "eez_id", "fao_area_id", (MAIN, SUB), C.EEZ),
        Layer("high_seas", C.HIGH_SEAS, "fao_area_id", 0, (MAIN,), C.HIGH_SEAS,
              score="one", allowed=True),
        Layer("lme", C.LME, "lme_id", 0, (MAIN,), C.LME,
              discard_rule=False, end_use_price=False, gear_join=True, allowed=True),
        Layer("rfmo", C.RFMO, "rfmo_id", 0, (MAIN,), C.RFMO, allowed=True),
        Layer("global", C.GLOBAL, 1, "area_id", (SUB,), C.GLOBAL,
              discard_rule=False, end_use_price=False, score="null", gear_join=True),
        # The IFA fact is written as layer 14 but looks its areas up among the EEZ areas.
        Layer("ifa", C.IFA, "eez_id", "fao_area_id", (MAIN, SUB), C.EEZ),
        Layer("meow", C.MEOW, "meow_id", 0, (MAIN,), C.MEOW, allowed=True),
    )
}
