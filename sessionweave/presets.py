"""Parameters of the feature job.

Every cut-off, name list and rule is a field of ``FeatureParams`` so that the
operators serve any event log; the defaults are the values of the game log the
job was designed for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------

LEVEL_GROUPS = ("0-4", "5-12", "13-22")
LEVELS = tuple(range(23))

CATEGORY_COLUMNS = ("event_name", "name", "fqid", "room_fqid", "text_fqid")
NUMERIC_COLUMNS = (
    "page",
    "room_coor_x",
    "room_coor_y",
    "screen_coor_x",
    "screen_coor_y",
    "hover_duration",
    "elapsed_time_diff",
)

EVENT_NAMES = (
    "cutscene_click",
    "person_click",
    "navigate_click",
    "observation_click",
    "notification_click",
    "object_click",
    "object_hover",
    "map_hover",
    "map_click",
    "checkpoint",
    "notebook_click",
)
NAMES = ("basic", "undefined", "close", "open", "prev", "next")
WORDS = ("that", "this", "it", "you", "flag", "can", "and", "is", "the", "to")
ROOMS = (
    "tunic.historicalsociety.entry",
    "tunic.wildlife.center",
    "tunic.historicalsociety.cage",
    "tunic.library.frontdesk",
    "tunic.historicalsociety.frontdesk",
    "tunic.historicalsociety.stacks",
    "tunic.historicalsociety.closet_dirty",
    "tunic.humanecology.frontdesk",
    "tunic.historicalsociety.basement",
    "tunic.kohlcenter.halloffame",
    "tunic.library.microfiche",
    "tunic.drycleaner.frontdesk",
    "tunic.historicalsociety.collection",
    "tunic.historicalsociety.closet",
    "tunic.flaghouse.entry",
    "tunic.historicalsociety.collection_flag",
    "tunic.capitol_1.hall",
    "tunic.capitol_0.hall",
    "tunic.capitol_2.hall",
)
# Objects and dialogue texts with features of their own, in the order of their names.
FQIDS = (
    "worker",
    "archivist",
    "gramps",
    "wells",
    "toentry",
    "confrontation",
    "crane_ranger",
    "groupconvo",
    "flag_girl",
    "tomap",
    "tostacks",
    "tobasement",
    "archivist_glasses",
    "boss",
    "journals",
    "seescratches",
    "groupconvo_flag",
    "cs",
    "teddy",
    "expert",
    "businesscards",
    "ch3start",
    "tunic.historicalsociety",
    "tofrontdesk",
    "savedteddy",
    "plaque",
    "glasses",
    "tunic.drycleaner",
    "reader_flag",
    "tunic.library",
    "tracks",
    "tunic.capitol_2",
    "trigger_scarf",
    "reader",
    "directory",
    "tunic.capitol_1",
    "journals.pic_0.next",
    "unlockdoor",
    "tunic",
    "what_happened",
    "tunic.kohlcenter",
    "tunic.humanecology",
    "colorbook",
    "logbook",
    "businesscards.card_0.next",
    "journals.hub.topics",
    "logbook.page.bingo",
    "journals.pic_1.next",
    "journals_flag",
    "reader.paper0.next",
    "tracks.hub.deer",
    "reader_flag.paper0.next",
    "trigger_coffee",
    "wellsbadge",
    "journals.pic_2.next",
    "tomicrofiche",
    "journals_flag.pic_0.bingo",
    "plaque.face.date",
    "notebook",
    "tocloset_dirty",
    "businesscards.card_bingo.bingo",
    "businesscards.card_1.next",
    "tunic.wildlife",
    "tunic.hub.slip",
    "tocage",
    "journals.pic_2.bingo",
    "tocollectionflag",
    "tocollection",
    "chap4_finale_c",
    "chap2_finale_c",
    "lockeddoor",
    "journals_flag.hub.topics",
    "tunic.capitol_0",
    "reader_flag.paper2.bingo",
    "photo",
    "tunic.flaghouse",
    "reader.paper1.next",
    "directory.closeup.archivist",
    "intro",
    "businesscards.card_bingo.next",
    "reader.paper2.bingo",
    "retirement_letter",
    "remove_cup",
    "journals_flag.pic_0.next",
    "magnify",
    "coffee",
    "key",
    "togrampa",
    "reader_flag.paper1.next",
    "janitor",
    "tohallway",
    "chap1_finale",
    "report",
    "outtolunch",
    "journals_flag.hub.topics_old",
    "journals_flag.pic_1.next",
    "reader.paper2.next",
    "chap1_finale_c",
    "reader_flag.paper2.next",
    "door_block_talk",
    "journals_flag.pic_1.bingo",
    "journals_flag.pic_2.next",
    "journals_flag.pic_2.bingo",
    "block_magnify",
    "reader.paper0.prev",
    "block",
    "reader_flag.paper0.prev",
    "block_0",
    "door_block_clean",
    "reader.paper2.prev",
    "reader.paper1.prev",
    "doorblock",
    "tocloset",
    "reader_flag.paper2.prev",
    "reader_flag.paper1.prev",
    "block_tomap2",
    "journals_flag.pic_0_old.next",
    "journals_flag.pic_1_old.next",
    "block_tocollection",
    "block_nelson",
    "journals_flag.pic_2_old.next",
    "block_tomap1",
    "block_badge",
    "need_glasses",
    "block_badge_2",
    "fox",
    "block_1",
)
TEXT_FQIDS = (
    "tunic.historicalsociety.cage.confrontation",
    "tunic.wildlife.center.crane_ranger.crane",
    "tunic.historicalsociety.frontdesk.archivist.newspaper",
    "tunic.historicalsociety.entry.groupconvo",
    "tunic.wildlife.center.wells.nodeer",
    "tunic.historicalsociety.frontdesk.archivist.have_glass",
    "tunic.drycleaner.frontdesk.worker.hub",
    "tunic.historicalsociety.closet_dirty.gramps.news",
    "tunic.humanecology.frontdesk.worker.intro",
    "tunic.historicalsociety.frontdesk.archivist_glasses.confrontation",
    "tunic.historicalsociety.basement.seescratches",
    "tunic.historicalsociety.collection.cs",
    "tunic.flaghouse.entry.flag_girl.hello",
    "tunic.historicalsociety.collection.gramps.found",
    "tunic.historicalsociety.basement.ch3start",
    "tunic.historicalsociety.entry.groupconvo_flag",
    "tunic.library.frontdesk.worker.hello",
    "tunic.library.frontdesk.worker.wells",
    "tunic.historicalsociety.collection_flag.gramps.flag",
    "tunic.historicalsociety.basement.savedteddy",
    "tunic.library.frontdesk.worker.nelson",
    "tunic.wildlife.center.expert.removed_cup",
    "tunic.library.frontdesk.worker.flag",
    "tunic.historicalsociety.frontdesk.archivist.hello",
    "tunic.historicalsociety.closet.gramps.intro_0_cs_0",
    "tunic.historicalsociety.entry.boss.flag",
    "tunic.flaghouse.entry.flag_girl.symbol",
    "tunic.historicalsociety.closet_dirty.trigger_scarf",
    "tunic.drycleaner.frontdesk.worker.done",
    "tunic.historicalsociety.closet_dirty.what_happened",
    "tunic.wildlife.center.wells.animals",
    "tunic.historicalsociety.closet.teddy.intro_0_cs_0",
    "tunic.historicalsociety.cage.glasses.afterteddy",
    "tunic.historicalsociety.cage.teddy.trapped",
    "tunic.historicalsociety.cage.unlockdoor",
    "tunic.historicalsociety.stacks.journals.pic_2.bingo",
    "tunic.historicalsociety.entry.wells.flag",
    "tunic.humanecology.frontdesk.worker.badger",
    "tunic.historicalsociety.stacks.journals_flag.pic_0.bingo",
    "tunic.historicalsociety.closet.intro",
    "tunic.historicalsociety.closet.retirement_letter.hub",
    "tunic.historicalsociety.entry.directory.closeup.archivist",
    "tunic.historicalsociety.collection.tunic.slip",
    "tunic.kohlcenter.halloffame.plaque.face.date",
    "tunic.historicalsociety.closet_dirty.trigger_coffee",
    "tunic.drycleaner.frontdesk.logbook.page.bingo",
    "tunic.library.microfiche.reader.paper2.bingo",
    "tunic.kohlcenter.halloffame.togrampa",
    "tunic.capitol_2.hall.boss.haveyougotit",
    "tunic.wildlife.center.wells.nodeer_recap",
    "tunic.historicalsociety.cage.glasses.beforeteddy",
    "tunic.historicalsociety.closet_dirty.gramps.helpclean",
    "tunic.wildlife.center.expert.recap",
    "tunic.historicalsociety.frontdesk.archivist.have_glass_recap",
    "tunic.historicalsociety.stacks.journals_flag.pic_1.bingo",
    "tunic.historicalsociety.cage.lockeddoor",
    "tunic.historicalsociety.stacks.journals_flag.pic_2.bingo",
    "tunic.historicalsociety.collection.gramps.lost",
    "tunic.historicalsociety.closet.notebook",
    "tunic.historicalsociety.frontdesk.magnify",
    "tunic.humanecology.frontdesk.businesscards.card_bingo.bingo",
    "tunic.wildlife.center.remove_cup",
    "tunic.library.frontdesk.wellsbadge.hub",
    "tunic.wildlife.center.tracks.hub.deer",
    "tunic.historicalsociety.frontdesk.key",
    "tunic.library.microfiche.reader_flag.paper2.bingo",
    "tunic.flaghouse.entry.colorbook",
    "tunic.wildlife.center.coffee",
    "tunic.capitol_1.hall.boss.haveyougotit",
    "tunic.historicalsociety.basement.janitor",
    "tunic.historicalsociety.collection_flag.gramps.recap",
    "tunic.wildlife.center.wells.animals2",
    "tunic.flaghouse.entry.flag_girl.symbol_recap",
    "tunic.historicalsociety.closet_dirty.photo",
    "tunic.historicalsociety.stacks.outtolunch",
    "tunic.library.frontdesk.worker.wells_recap",
    "tunic.historicalsociety.frontdesk.archivist_glasses.confrontation_recap",
    "tunic.capitol_0.hall.boss.talktogramps",
    "tunic.historicalsociety.closet.photo",
    "tunic.historicalsociety.collection.tunic",
    "tunic.historicalsociety.closet.teddy.intro_0_cs_5",
    "tunic.historicalsociety.closet_dirty.gramps.archivist",
    "tunic.historicalsociety.closet_dirty.door_block_talk",
    "tunic.historicalsociety.entry.boss.flag_recap",
    "tunic.historicalsociety.frontdesk.archivist.need_glass_0",
    "tunic.historicalsociety.entry.wells.talktogramps",
    "tunic.historicalsociety.frontdesk.block_magnify",
    "tunic.historicalsociety.frontdesk.archivist.foundtheodora",
    "tunic.historicalsociety.closet_dirty.gramps.nothing",
    "tunic.historicalsociety.closet_dirty.door_block_clean",
    "tunic.capitol_1.hall.boss.writeitup",
    "tunic.library.frontdesk.worker.nelson_recap",
    "tunic.library.frontdesk.worker.hello_short",
    "tunic.historicalsociety.stacks.block",
    "tunic.historicalsociety.frontdesk.archivist.need_glass_1",
    "tunic.historicalsociety.entry.boss.talktogramps",
    "tunic.historicalsociety.frontdesk.archivist.newspaper_recap",
    "tunic.historicalsociety.entry.wells.flag_recap",
    "tunic.drycleaner.frontdesk.worker.done2",
    "tunic.library.frontdesk.worker.flag_recap",
    "tunic.humanecology.frontdesk.block_0",
    "tunic.library.frontdesk.worker.preflag",
    "tunic.historicalsociety.basement.gramps.seeyalater",
    "tunic.flaghouse.entry.flag_girl.hello_recap",
    "tunic.historicalsociety.closet.doorblock",
    "tunic.drycleaner.frontdesk.worker.takealook",
    "tunic.historicalsociety.basement.gramps.whatdo",
    "tunic.library.frontdesk.worker.droppedbadge",
    "tunic.historicalsociety.entry.block_tomap2",
    "tunic.library.frontdesk.block_nelson",
    "tunic.library.microfiche.block_0",
    "tunic.historicalsociety.entry.block_tocollection",
    "tunic.historicalsociety.entry.block_tomap1",
    "tunic.historicalsociety.collection.gramps.look_0",
    "tunic.library.frontdesk.block_badge",
    "tunic.historicalsociety.cage.need_glasses",
    "tunic.library.frontdesk.block_badge_2",
    "tunic.kohlcenter.halloffame.block_0",
    "tunic.capitol_0.hall.chap1_finale_c",
    "tunic.capitol_1.hall.chap2_finale_c",
    "tunic.capitol_2.hall.chap4_finale_c",
    "tunic.wildlife.center.fox.concern",
    "tunic.drycleaner.frontdesk.block_0",
    "tunic.historicalsociety.entry.gramps.hub",
    "tunic.humanecology.frontdesk.block_1",
    "tunic.drycleaner.frontdesk.block_1",
)
GRID_ROOMS = {
    "0-4": (
        "tunic.kohlcenter.halloffame",
        "tunic.historicalsociety.stacks",
        "tunic.historicalsociety.basement",
        "tunic.historicalsociety.collection",
        "tunic.historicalsociety.entry",
        "tunic.historicalsociety.closet",
    ),
    "5-12": (
        "tunic.historicalsociety.frontdesk",
        "tunic.capitol_0.hall",
        "tunic.capitol_1.hall",
        "tunic.library.microfiche",
        "tunic.historicalsociety.closet_dirty",
        "tunic.historicalsociety.basement",
        "tunic.historicalsociety.collection",
        "tunic.library.frontdesk",
        "tunic.historicalsociety.stacks",
        "tunic.drycleaner.frontdesk",
        "tunic.historicalsociety.entry",
        "tunic.humanecology.frontdesk",
        "tunic.kohlcenter.halloffame",
    ),
    "13-22": (
        "tunic.historicalsociety.stacks",
        "tunic.flaghouse.entry",
        "tunic.kohlcenter.halloffame",
        "tunic.capitol_2.hall",
        "tunic.historicalsociety.closet_dirty",
        "tunic.historicalsociety.basement",
        "tunic.capitol_1.hall",
        "tunic.historicalsociety.entry",
        "tunic.historicalsociety.frontdesk",
        "tunic.library.frontdesk",
        "tunic.historicalsociety.collection_flag",
        "tunic.humanecology.frontdesk",
        "tunic.wildlife.center",
        "tunic.library.microfiche",
        "tunic.historicalsociety.cage",
    ),
}

FQID_NONE = "fqid_None"
TEXT_FQID_NONE = "text_fqid_None"

# Sessions with labels but no log for a group, or the other way round.
BROKEN_SESSIONS = (22080308213749430, 22080309230203028, 22080409272258496)

GAP_FLAGS = (10000, 20000, 50000, 100000, 200000, 500000)
GAP_CAP = 20000
GROUP_ADD_ON = {"0-4": 860552, "5-12": 1102255, "13-22": 428119}
END_LEVELS = (4, 12, 22)
POPULARITY_CUTS = (400, 1500, 4000, 10000)

QUESTIONS = tuple(range(1, 19))
QUESTION_GROUPS = (("0-4", 1, 3), ("5-12", 4, 13), ("13-22", 14, 22))
QUESTION_PRIORS = (
    0.728, 0.978, 0.933, 0.8, 0.548, 0.776, 0.736, 0.612, 0.734,
    0.505, 0.642, 0.86, 0.275, 0.707, 0.481, 0.733, 0.684, 0.95,
)
DEFAULT_THRESHOLD = 0.620
# Thresholds are 0.600 .. 0.650 by 0.001, kept as thousandths.
THRESHOLD_GRID = (600, 650)

NULL_RATE = 0.97
NULL_RATE_ABOVE = 0.997

# Learning parameters and numbers of trees.
BOOSTED_PARAMS = {
    "base": {"learning_rate": 0.02, "alpha": 8, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.5, "random_state": 42},
    "n_estimators": [707, 390, 390, 548, 608, 439, 524, 274, 301, 305, 309, 261, 489, 365, 379, 329, 257, 378],
}
# The same with early stopping.
BOOSTED_EARLY_STOP_PARAMS = {
    "base": {"learning_rate": 0.02, "alpha": 8, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.5, "random_state": 42, "early_stopping_rounds": 60},
    "n_estimators": [1200],
}
# Parameters of the forest.
FOREST_PARAMS = {
    "base": {"max_depth": 5, "criterion": "gini", "random_state": 42},
    "n_estimators": [100],
}

# --- milestone rules --------------------------------------------------------


@dataclass(frozen=True)
class Milestone:
    """Span between the first and last row that meets any of ``any_of``.

    ``any_of`` holds predicates; a predicate is a tuple of (column, value)
    pairs that must all hold.
    """

    level_group: str
    name: str
    any_of: tuple
    index_name: str | None = None


@dataclass(frozen=True)
class Transition:
    """First row that meets ``after`` minus last row that meets ``before``."""

    level_group: str
    name: str
    before: tuple
    after: tuple


def _text(*values):
    return tuple((("text", v),) for v in values)


# Texts and objects of the game log.
MILESTONES = (
    Milestone("0-4", "shirt_watch", _text("It's a women's basketball jersey!", "That settles it.")),
    Milestone("0-4", "notebook_found", _text("Now where did I put my notebook?", "Found it!")),
    Milestone("5-12", "logbook_bingo", _text("Here's the log book.") + ((("fqid", "logbook.page.bingo"),),)),
    Milestone("5-12", "businesscard_bingo", ((("fqid", "businesscards"),), (("fqid", "businesscards.card_bingo.bingo"),))),
    Milestone("5-12", "reader_bingo", ((("event_name", "navigate_click"), ("fqid", "reader")), (("fqid", "reader.paper2.bingo"),))),
    Milestone("5-12", "journals_bingo", ((("event_name", "navigate_click"), ("fqid", "journals")), (("fqid", "journals.pic_2.bingo"),))),
    Milestone("5-12", "go_to_library", _text("Hmmm... not sure. Why don't you try the library?", "Oh, hello there!")),
    Milestone("5-12", "go_to_archivist", _text("You could ask the archivist. He knows everybody!", "Do you have any info on Theodora Youmans?")),
    Milestone("13-22", "l15_glasses_bingo", _text("I'll go look at everyone's pictures!", "Those are the same glasses!")),
    Milestone("13-22", "l15_archivist_key", _text("Yes! It's the key for Teddy's cage!", "Those are the same glasses!")),
    Milestone("13-22", "l17_grampa_wating", _text("Your grampa is waiting for you in the collection room.", "The archivist had him locked up!")),
    Milestone("13-22", "l18_hoofprint_bingo", _text("Go take a look!", "That hoofprint doesn't match the flag!"), "l18_hoofprint"),
    Milestone("13-22", "l18_go_to_wildlife", _text("Hmm. You could try the Aldo Leopold Wildlife Center.", "Oh no! What happened to that crane?")),
    Milestone("13-22", "l19_go_to_flag_expert", _text("Hey, nice dog! What breed is he?", "Actually, I went to school with somebody who LOVES old flags.")),
    Milestone("13-22", "l19_ecologyflag_check", _text("It's an ecology flag!", "Hey, I've seen that symbol before! Check it out!")),
    Milestone("13-22", "l20_reader_flag", ((("event_name", "navigate_click"), ("fqid", "reader_flag")), (("text_fqid", "tunic.library.microfiche.reader_flag.paper2.bingo"),))),
    Milestone("13-22", "l21_journalsFlag_bingo", ((("event_name", "navigate_click"), ("fqid", "journals_flag")), (("fqid", "journals_flag.pic_0.bingo"),))),
)
TRANSITIONS = (
    Transition("0-4", "to_shirt", _text("Hey Jo, let's take a look at the shirt!"), ((("text_fqid", "tunic.historicalsociety.collection.cs"),),)),
    Transition("5-12", "found_glasses", ((("text_fqid", "tunic.historicalsociety.frontdesk.archivist.hello"),),), ((("text_fqid", "tunic.historicalsociety.frontdesk.magnify"),),)),
)


@dataclass(frozen=True)
class FeatureParams:
    """Options and values of one feature job.

    ``vocabularies`` limits a dimension to listed values; a dimension that is
    not listed takes every non-sentinel value found in the log. ``fitted``
    gives a dimension the values that this share of a group's sessions has instead.
    """

    version: int = 2
    extra: bool = True
    level_diff: bool = True
    cut_above: bool = True
    room_click: bool = True
    cap_gaps: bool = False
    null_rate: float = NULL_RATE
    time_parts: int = 6

    levels: tuple = LEVELS
    level_groups: tuple = LEVEL_GROUPS
    vocabularies: dict = field(
        default_factory=lambda: {"event_name": EVENT_NAMES, "name": NAMES, "room_fqid": ROOMS, "fqid": FQIDS, "text_fqid": TEXT_FQIDS}
    )
    fitted: dict = field(default_factory=dict)
    words: tuple = WORDS
    gap_flags: tuple = GAP_FLAGS
    gap_cap: int = GAP_CAP
    group_add_on: dict = field(default_factory=lambda: dict(GROUP_ADD_ON))
    end_levels: tuple = END_LEVELS
    no_gap_levels: tuple = END_LEVELS
    level_ranges: tuple = ((0, 4), (5, 12), (13, 22))
    above_groups: tuple = ("0-4", "5-12")
    milestones: tuple = MILESTONES
    transitions: tuple = TRANSITIONS
    support: float = 0.03
    text_support: float = 0.03
    event_level_events: tuple = ("notebook_click", "map_click", "object_click", "observation_click", "person_click")
    pair_events: tuple = ("map_click", "notebook_click")
    repeat_min: int = 5
    navigate_event: str = "navigate_click"
    cell_size: int = 200
    popularity_cuts: tuple = POPULARITY_CUTS
    grid_size: int = 180
    grid_rooms: dict = field(default_factory=lambda: dict(GRID_ROOMS))
    grid_clip: int = 3
