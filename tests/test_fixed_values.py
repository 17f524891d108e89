"""Fixed values spelled out once more: the SQL twins take some of them from the code, so they alone would not notice."""

from riskbook.functions import details, energy, flood, palettes
from riskbook.operators import report


def test_palettes():
    assert list(palettes.BER_COLOURS) == "A1 A2 A3 B1 B2 B3 C1 C2 C3 D1 D2 E1 E2 F G".split()
    by_letter = {"A": "#00a54f", "B": "#4cb848", "C": "#bed630", "D": "#fff101", "E": "#fcb814", "F": "#f36e21", "G": "#ee1d23"}
    assert palettes.BER_COLOURS == {code: by_letter[code[0]] for code in palettes.BER_COLOURS}
    assert palettes.EPC_COLOURS == {None: "#deebf6", **by_letter}
    assert list(palettes.EPC_COLOURS_CLASSIC.values()) == [
        "#007e2e", "#2c9f29", "#a1d20e", "#f8f400", "#f1c300", "#e77c17", "#df0024", "#ffffff",
    ]
    assert list(palettes.ENVIRONMENT_COLOURS.values()) == [
        "#cde2f5", "#97c0e6", "#73a2d6", "#4e84c4", "#a5a6a9", "#919194", "#807f83", "#ffffff",
    ]
    flood_colours = ["#deebf6", "#a5d45d", "#ecc63a", "#d92424", "#919191", "#242424"]
    assert list(palettes.FLOOD_INDEX_COLOURS.items()) == list(
        zip(["No Colour", "green", "amber", "red", "black 1", "black 2"], flood_colours)
    )
    assert list(palettes.FLOOD_SCORE_COLOURS.items()) == list(
        zip(["no-colour", "green", "amber", "red", "black-1", "black-2", "purple"], [*flood_colours, "#9370db"])
    )
    assert palettes.FLOOD_SCORE_LABELS == (
        "Very Low", "Low", "Moderate", "Moderate to High", "High", "Very High", "ERROR",
    )


def test_bands():
    assert flood.FLOOD_BANDS == (
        (0, "no-colour"), (10, "green"), (29, "amber"), (45, "red"), (60, "black-1"), (100, "black-2"),
    )
    assert energy.BAND_TEXTS == (
        "0; <= 100", "> 100; <= 200", "> 200; <= 300", "> 300; <= 400", "> 400; <= 500", "> 500",
    )


def test_return_periods():
    periods = [(hazard, years) for hazard, years, _, _ in details.RETURN_PERIODS]
    assert periods == [("river", y) for y in (20, 75, 100, 200, 1000)] + [
        ("coastal", y) for y in (75, 100, 200, 1000)
    ] + [(periods[-1][0], y) for y in (75, 200, 1000)]
    assert {name for _, _, name, _ in details.RETURN_PERIODS} == {
        "rmax20", "rmax75", "rmax100", "rmax200", "rmax1000", "cudmax75", "cudmax100", "cudmax200", "cudmax1000",
        "swmax75", "swmax200", "swmax1000",
    }


def test_template():
    texts = [text.format(area="EU") for text in report.TEMPLATE_ROWS]
    assert texts[0] == "Total EU area" and texts[5] == "Total non-EU area" and texts[1:5] == texts[6:]
    assert texts[1:5] == [
        "Of which Loans collateralised by commercial immovable property",
        "Of which Loans collateralised by residential immovable property",
        "Of which Collateral obtained by taking possession: residential and commercial immovable properties",
        "Of which Level of energy efficiency (EP score in kWh/m² of collateral) estimated",
    ]
    assert report.MEASURED_ROWS == (1, 3)
