"""Generated match and timeline documents."""

import json

DAY = 86_400_000
START = 1_756_771_200_000  # 2025-09-02 00:00 UTC


def participant(puuid, role="TOP", win=True, challenges=None, **fields):
    base = {
        "puuid": puuid, "riotIdGameName": puuid.lower(), "riotIdTagline": "TAG", "championName": "Ahri", "teamPosition": role,
        "individualPosition": role, "win": win, "kills": 5, "deaths": 3, "assists": 7, "totalMinionsKilled": 100,
        "neutralMinionsKilled": 20, "goldEarned": 9000, "totalDamageDealtToChampions": 15000, "visionScore": 20,
        "firstBloodKill": False, "gameEndedInSurrender": False, "totalTimeSpentDead": 60, "timeCCingOthers": 7.5,
    }
    if challenges is not False:
        base["challenges"] = {"kda": 4.0, "killParticipation": 0.5, "goldPerMinute": 300.5,
                              "maxCsAdvantageOnLaneOpponent": 10.0, **(challenges or {})}
    return {**base, **fields}


def match(number, people, day=0, queue=420, seconds=1801, version="16.17.1", platform="LA2"):
    return {
        "metadata": {"matchId": f"{platform}_{number}"},
        "info": {"gameCreation": START + day * DAY + 1234, "gameDuration": seconds, "gameMode": "CLASSIC", "queueId": queue,
                 "gameVersion": version, "participants": people},
    }


def landed(*pairs):
    """(puuid, document text) rows; a document may be given as text already."""
    return [(puuid, d if isinstance(d, str) else json.dumps(d)) for puuid, d in pairs]


def timeline(people, minutes=(0, 1, 2), final=True):
    def frame(ms, extra=0):
        return {"timestamp": ms, "participantFrames": {
            str(i + 1): {"totalGold": 500 + ms // 100 * (i + 1) + extra, "xp": ms // 1000, "minionsKilled": ms // 10000 + i,
                         "jungleMinionsKilled": 1, "level": 1 + ms // 60000} for i in range(len(people))}}
    frames = [frame(m * 60000) for m in minutes]
    if final:
        frames.append(frame(minutes[-1] * 60000 + 20000, 5000))
    return {"info": {"participants": [{"participantId": i + 1, "puuid": p} for i, p in enumerate(people)], "frames": frames}}
