"""Small sample documents of each kind."""

#: 13:30:45, 14:16:03 and 14:26:03 on 2 November 2025.
FIRST, SECOND, THIRD = 1762090245, 1762092963, 1762093563


def _division(id_, ladder, members):
    return {"id": id_, "ladder_id": ladder, "member_count": members}


def league():
    """A small upper tier and a lower one of three divisions."""
    return {
        "key": {"season_id": 81, "queue_id": 340, "team_type": 1, "league_id": 2},
        "tier": [
            {"id": 6, "min_rating": 2900, "max_rating": 3050, "division": [_division(61, "5501", 17)]},
            {
                "id": 7,
                "min_rating": 2750,
                "max_rating": 2899,
                "division": [_division(71, 5520, 22), _division(72, "5533", 8), _division(73, 5547, 30)],
            },
        ],
    }


def _member(id_, name, **games):
    return {
        "legacy_link": {"id": id_, "realm": 1, "name": name},
        "character_link": {"battle_tag": f"{name}#77"},
        "played_race_count": [{"race": {"en_US": r}, "count": n} for r, n in games.items()],
    }


def modern():
    """Mira's team and one without an id on the first ladder, Odo's on the second."""
    mira = {
        "id": 17000000000000000001,
        "rating": 3010,
        "wins": 11,
        "losses": 6,
        "join_time_stamp": 1761000300,
        "member": [_member(30411, "Mira", Protoss=12, Zerg=3)],
    }
    visitor = {"rating": None, "member": [_member(None, "Visitor")]}
    odo = {"id": 44, "rating": 2805, "member": [_member("30977", "Odo", Terran=9)]}
    return [{"ladder_id": 5501, "data": {"team": [mira, visitor]}}, {"ladder_id": 5520, "data": {"team": [odo]}}]


def _legacy_member(id_, name, wins, losses, clan=None, realm=1, region=2):
    character = {"id": id_, "realm": realm, "region": region, "displayName": name, "clanName": clan, "clanTag": clan}
    return {
        "character": {**character, "profilePath": f"/who/{id_}"},
        "joinTimestamp": 1761000300,
        "points": 73,
        "wins": wins,
        "losses": losses,
        "highestRank": 4,
        "previousRank": 9,
        "favoriteRaceP1": "PROTOSS",
    }


def legacy(members=None):
    """One ladder per member."""
    members = members or [("30411", "Mira", 11, 6, "OAK"), (30977, "Odo", 7, 2, None)]
    return [
        {"ladder_id": 5600 + i, "data": {"ladderMembers": [_legacy_member(*m)]}}
        for i, m in enumerate(members)
    ]


def _history(player, *matches):
    listed = [
        {"date": date, "map": map_, "type": "1v1", "decision": decision, "speed": "FASTER"}
        for date, map_, decision in matches
    ]
    return {"request_profile_id": player, "request_realm_id": 2, "request_region_id": 1, "matches": listed}


def matches():
    """Odo and Mira met once; she played twice more; a third player has not played."""
    return [
        _history(30977, (FIRST, "Salt Flats", "LOSS")),
        _history(31555),
        _history(30411, (FIRST, "Salt Flats", "WIN"), (SECOND, "Old Mill", "LOSS"), (THIRD, "Salt Flats", "TIE")),
    ]


def match_without_map():
    return [_history(31555, (THIRD, None, "WIN"))]
