"""Deterministic lookup services used by the enrichment queries.

They stand in for the catalogue endpoints: every answer is computed from the
id alone, so the results can be reproduced in SQL. Failure rules: an id
divisible by 7 gets an error document, by 11 a 404, by 13 a body that is not
JSON; for the child lookup an id divisible by 5 is a missing parent."""

from __future__ import annotations

import json

ARTIST_BODY_SCHEMA = ("id long, name string, link string, nb_fan long")

TRACKS_BODY_SCHEMA = (
    "tracks array<struct<id: string, name: string, popularity: long, "
    "artists: array<struct<id: string, name: string>>, available_markets: array<string>, "
    "external_urls: struct<spotify: string>, "
    "external_ids: struct<isrc: string, ean: string, upc: string>>>")

MARKETS = ("FR", "US", "DE")


def artist_lookup(ids):
    for text in ids:
        i = int(text)
        if i % 7 == 0:
            yield text, 200, json.dumps({"error": {"type": "DataException", "code": 800}})
        elif i % 11 == 0:
            yield text, 404, "not found"
        elif i % 13 == 0:
            yield text, 200, "<html>busy</html>"
        else:
            yield text, 200, json.dumps({
                "id": i, "name": f"artist {i}",
                "link": f"https://catalogue.example/artist/{i}",
                "nb_fan": (i * 37) % 100000})


def failing_lookup(ids):
    """The artist lookup, but a call that holds an id divisible by 19 raises."""
    for text in ids:
        if int(text) % 19 == 0:
            raise ConnectionError(f"no answer for {text}")
    yield from artist_lookup(ids)


def top_tracks_lookup(ids):
    """Each id has ``id % 4`` tracks; track j has j artists (none -> null
    joins), markets absent when j == 1 and the first j markets otherwise, and
    no ean when j is even."""
    for text in ids:
        i = int(text)
        if i % 5 == 0:
            yield text, 404, json.dumps({"error": {"status": 404}})
            continue
        tracks = []
        for j in range(i % 4):
            track = {
                "id": f"t{i}-{j}", "name": f"track {j} of {i}", "popularity": (i + j) % 100,
                "artists": [{"id": f"a{i + m}", "name": f"artist {i + m}"} for m in range(j)],
                "external_urls": {"spotify": f"https://open.example/track/{i}-{j}"},
                "external_ids": {"isrc": f"ISRC{i:08d}{j}", "upc": f"UPC{i}"},
            }
            if j != 1:
                track["available_markets"] = list(MARKETS[:j])
            if j % 2 == 1:
                track["external_ids"]["ean"] = f"EAN{i}{j}"
            tracks.append(track)
        yield text, 200, json.dumps({"tracks": tracks})


ARTISTS_BATCH_SCHEMA = (
    "artists array<struct<id: string, name: string, genres: array<string>, "
    "external_urls: struct<spotify: string>, popularity: long, followers: struct<total: long>>>")

GENRES = ("rock", "Pop")


def artists_batch_lookup(ids):
    """A batch endpoint: one response for the whole batch, ``{"artists": [...]}``
    in request order. Id divisible by 17: a null record; by 3: no genres, else
    the first ``id % 3`` genres; by 5: no followers object."""
    artists = []
    for text in ids:
        i = int(text)
        if i % 17 == 0:
            artists.append(None)
            continue
        artist = {"id": f"sp{i}", "name": f"artist {i}", "genres": list(GENRES[: i % 3]),
                  "external_urls": {"spotify": f"https://open.example/artist/sp{i}"},
                  "popularity": i % 100}
        if i % 5 != 0:
            artist["followers"] = {"total": i * 7}
        artists.append(artist)
    yield ",".join(ids), 200, json.dumps({"artists": artists})

