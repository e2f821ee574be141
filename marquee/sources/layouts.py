"""Column layouts of the sample files, and the feature columns of the models on them.

A file layout maps each column to its default, which also gives its type, or, for files
with a header, to its Spark type.  A feature layout lists the columns that become features.
"""

from __future__ import annotations

from marquee.functions.encoders import GENRE_VOCABULARY, W2V_SCORE_BOUNDS
from marquee.operators.feature_layout import Bounded, Crossed, Hashed, Identity, Number, Words

# The 42 columns of the tag samples, in file order.
TAG_SAMPLES: dict[str, object] = {
    "label": 0,
    "tagid": "",
    "showcityid": "",
    "showcate1": "",
    "showcate2": "",
    "showcate3": "",
    "tagcate2ctr": 0.0,
    "tagcate3ctr": 0.0,
    "tagallcatectr": 0.0,
    "tagallctr": 0.0,
    "clicktag": "",
    "searchkey": "",
    "tagcate1": "",
    "tagcate2": "",
    "tagcate3": "",
    "has2dispcate": 0,
    "has3dispcate": 0,
    "cpcandiscore": 0.0,
    "ctrcandiscore": 0.0,
    "querycandiscore": 0.0,
    "weightcandiscore": 0.0,
    "containedcandiscore": 0.0,
    "isdefaultcandi": 0,
    "isnewtagcandi": 0,
    "UserClickTagsHistory": 0.0,
    "TagUserActionsCf": 0.0,
    "TagUserActionsCfRnn": 0.0,
    "User24HActions": 0.0,
    "TagW2VScore": 0.0,
    "SearchW2VScore": 0.0,
    "tag1": "",
    "tag2": "",
    "tag3": "",
    "tag1w2vscore": 0.0,
    "tag2w2vscore": 0.0,
    "tag3w2vscore": 0.0,
    "s1": "",
    "s2": "",
    "s3": "",
    "s1w2vscore": 0.0,
    "s2w2vscore": 0.0,
    "s3w2vscore": 0.0,
}

# The 28 columns of the newer tag samples, in file order.
TAG_SAMPLES_NEW: dict[str, object] = {
    "label": 0,
    "tagid": "",
    "showcityid": "",
    "showcate1": "",
    "showcate2": "",
    "showcate3": "",
    "clicktag": "",
    "searchkey": "",
    "tagcate1": "",
    "tagcate2": "",
    "tagcate3": "",
    "has2dispcate": 0,
    "has3dispcate": 0,
    "cpcandiscore": 0.0,
    "ctrcandiscore": 0.0,
    "querycandiscore": 0.0,
    "weightcandiscore": 0.0,
    "contained_60": 0,
    "contained_40": 0,
    "isdefaultcandi": 0,
    "isnewtagcandi": 0,
    "UserClickTagsHistory": 0,
    "TagUserActionsCf": 0.0,
    "TagUserActionsCfRnn": 0.0,
    "User24HActions": 0.0,
    "User24HActionCF": 0.0,
    "TagW2VScore": 0.0,
    "SearchW2VScore": 0.0,
}

# The 28 columns of the listing samples, in file order.
LISTING_SAMPLES: dict[str, object] = {
    "label": 0,
    "infoId2": "",
    "infoCityId1": "",
    "infoCateId1": "",
    "infoCateId2": "",
    "deviceType": "",
    "postDayScore": 0.0,
    "createDayScore": 0.0,
    "businessScore": 0.0,
    "cvrScore": 0.0,
    "listCtrScore": 0.0,
    "detailCtrScore": 0.0,
    "callUvScore": 0.0,
    "ratingScore": 0.0,
    "business": "",
    "contentScore": 0.0,
    "picScore": 0.0,
    "areaScore": 0.0,
    "hasSearchText": "",
    "searchTextTermCount": 0.0,
    "overlapTermCount": 0.0,
    "overlapRatioBySearchText": 0.0,
    "overlapRatioByInfoTitle": 0.0,
    "highCommentScore": 0.0,
    "midCommentScore": 0.0,
    "lowCommentScore": 0.0,
    "allCommentScore": 0.0,
    "bizRank": 0,
}

# The columns of the movie samples, a file with a header.
MOVIE_SAMPLES: dict[str, object] = {
    "movieAvgRating": "float",
    "movieRatingStddev": "float",
    "movieRatingCount": "int",
    "userAvgRating": "float",
    "userRatingStddev": "float",
    "userRatingCount": "int",
    "releaseYear": "int",
    "movieId": "int",
    "userId": "int",
    "userRatedMovie1": "int",
    "userRatedMovie2": "int",
    "userRatedMovie3": "int",
    "userRatedMovie4": "int",
    "userRatedMovie5": "int",
    "userGenre1": "string",
    "userGenre2": "string",
    "userGenre3": "string",
    "userGenre4": "string",
    "userGenre5": "string",
    "movieGenre1": "string",
    "movieGenre2": "string",
    "movieGenre3": "string",
    "label": "int",
}

# The columns of the tag behaviour samples, a file with a header.
TAG_BEHAVIOUR: dict[str, object] = {
    "ctime": "string",
    "entityid": "int",
    "userid": "string",
    "cate1": "string",
    "cate2": "int",
    "cate3": "string",
    "actiontype": "string",
    "usertag1": "int",
    "usertag2": "int",
    "usertag3": "int",
    "label": "int",
}

# Feature columns of the tag samples.
TAG_FEATURES = [
    Hashed("tagid", 5000),
    Hashed("showcityid", 200),
    Hashed("showcate1", 100),
    Hashed("showcate2", 200),
    Hashed("showcate3", 1000),
    Hashed("clicktag", 1000),
    Hashed("searchkey", 2000),
    Hashed("tagcate1", 100),
    Hashed("tagcate2", 200),
    Hashed("tagcate3", 1000),
    Hashed("tag1", 5000),
    Hashed("tag2", 5000),
    Hashed("tag3", 5000),
    Hashed("s1", 2000),
    Hashed("s2", 2000),
    Hashed("s3", 2000),
    Number("tagcate2ctr"),
    Number("tagcate3ctr"),
    Number("tagallcatectr"),
    Number("tagallctr"),
    Number("cpcandiscore"),
    Number("ctrcandiscore"),
    Number("querycandiscore"),
    Number("weightcandiscore"),
    Number("containedcandiscore"),
    Number("UserClickTagsHistory"),
    Number("TagUserActionsCf"),
    Number("TagUserActionsCfRnn"),
    Number("User24HActions"),
    Number("TagW2VScore"),
    Number("SearchW2VScore"),
    Number("tag1w2vscore"),
    Number("tag2w2vscore"),
    Number("tag3w2vscore"),
    Number("s1w2vscore"),
    Number("s2w2vscore"),
    Number("s3w2vscore"),
    Number("has2dispcate"),
    Number("has3dispcate"),
    Number("isdefaultcandi"),
    Number("isnewtagcandi"),
]

# The word-vector scores of the tag samples in buckets.
TAG_SCORE_BUCKETS = [
    Bounded("TagW2VScore", W2V_SCORE_BOUNDS),
    Bounded("SearchW2VScore", W2V_SCORE_BOUNDS),
    Bounded("tag1w2vscore", W2V_SCORE_BOUNDS),
    Bounded("tag2w2vscore", W2V_SCORE_BOUNDS),
    Bounded("tag3w2vscore", W2V_SCORE_BOUNDS),
    Bounded("s1w2vscore", W2V_SCORE_BOUNDS),
    Bounded("s2w2vscore", W2V_SCORE_BOUNDS),
    Bounded("s3w2vscore", W2V_SCORE_BOUNDS),
]

# Feature columns of the listing samples.
LISTING_FEATURES = [
    Hashed("infoCityId1", 700),
    Hashed("infoCateId1", 20),
    Hashed("infoCateId2", 280),
    Number("postDayScore"),
    Number("createDayScore"),
    Number("businessScore"),
    Number("cvrScore"),
    Number("listCtrScore"),
    Number("detailCtrScore"),
    Number("callUvScore"),
    Number("ratingScore"),
    Number("contentScore"),
    Number("picScore"),
    Number("areaScore"),
    Number("highCommentScore"),
    Number("midCommentScore"),
    Number("lowCommentScore"),
    Number("allCommentScore"),
    Number("bizRank"),
    Words("deviceType", ["1", "2", "3"]),
    Words("business", ["0", "1"]),
    Words("hasSearchText", ["0", "1"]),
]

# Feature columns of the movie samples; the last one is the wide half.
MOVIE_FEATURES = [
    Words("userGenre1", GENRE_VOCABULARY),
    Words("userGenre2", GENRE_VOCABULARY),
    Words("userGenre3", GENRE_VOCABULARY),
    Words("userGenre4", GENRE_VOCABULARY),
    Words("userGenre5", GENRE_VOCABULARY),
    Words("movieGenre1", GENRE_VOCABULARY),
    Words("movieGenre2", GENRE_VOCABULARY),
    Words("movieGenre3", GENRE_VOCABULARY),
    Identity("movieId", 1001),
    Identity("userId", 30001),
    Number("releaseYear"),
    Number("movieRatingCount"),
    Number("movieAvgRating"),
    Number("movieRatingStddev"),
    Number("userRatingCount"),
    Number("userAvgRating"),
    Number("userRatingStddev"),
    Crossed(["movieId", "userRatedMovie1"], 10_000),
]

# Feature columns of the tag behaviour samples; the last one is the wide half.
BEHAVIOUR_FEATURES = [
    Identity("entityid", 160_000),
    Identity("cate2", 403_648),
    Crossed(["entityid", "usertag1"], 10_000),
]
