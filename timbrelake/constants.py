"""Names, patterns, bounds and labels that results have to match exactly."""

# --- Fixed values: catalogue layout -------------------------------------------------------
CATALOGUE_FIELDS = ["TRACK_ID", "ARTIST_ID", "ALBUM_ID", "PATH", "DURATION"]
MIN_CATALOGUE_FIELDS = 6
PATH_FIELD = 4
SOURCE_SUFFIX = ".low.mp3"
TARGET_SUFFIX = ".wav"
SOURCE_PREFIX = "audio/mp3"
TARGET_PREFIX = "audio/wav"

# --- Fixed values: keys and tags ----------------------------------------------------------
TAG_PREFIX = "genre---"
TRACK_KEY_PATTERN = r"track_0*([0-9]+)$"
FILE_KEY_PATTERN = r"([^/]+)\.low\.wav$"
TAG_PATTERN = r"genre---([^\t]+)"
TAG_PATTERN_NO_SPACE = r"genre---([^\t\s]+)"
WANTED_GENRES = ["folk", "rock", "electronic", "classical", "hiphop"]
MAX_PER_CLASS = 700
TOP_TAGS = 30
SAMPLE_SEED = 42
SAMPLE_FRACTION = 0.05
BATCH_SIZE = 200
USERS = 6

# --- Fixed values: signal features --------------------------------------------------------
SAMPLE_RATE = 16000
MIN_SAMPLES = 100
N_MFCC = 20
N_CONTRAST = 7
N_CHROMA = 12
N_TONNETZ = 6
STATISTICS = ["mean", "std", "min", "max"]
NOTES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
TONAL_AXES = ["5th", "Minor 3rd", "Major 3rd", "5th im", "m3 im", "M3 im"]
BANDS = ["Band 1", "Band 2", "Band 3", "Band 4", "Band 5", "Band 6", "Band 7"]

# --- Fixed values: profile of a data set --------------------------------------------------
TOP_GROUPS = 12
RADAR_GROUPS = 6
RADAR_COEFFICIENTS = 5
TEMPO_BOUNDS = [80, 100, 110, 120, 130, 140, 160]
TEMPO_BUCKETS = ["< 80", "80-100", "100-110", "110-120", "120-130", "130-140", "140-160", "160+"]
PROFILE_COLUMNS = [
    # source column, profile column, decimal places
    ("tempo", "tempo", 1),
    ("centroid_mean", "centroid", 0),
    ("rms_mean", "rms", 4),
    ("zcr_mean", "zcr", 4),
    ("flatness_mean", "flatness", 5),
    ("mfcc_1_mean", "mfcc1", 2),
    ("mfcc_2_mean", "mfcc2", 2),
    ("mfcc_3_mean", "mfcc3", 2),
    ("mfcc_4_mean", "mfcc4", 2),
    ("mfcc_5_mean", "mfcc5", 2),
]
COMPARED_FEATURES = ["tempo", "centroid_mean", "rms_mean", "zcr_mean", "flatness_mean"]
SUMMARY_COLUMNS = {
    "genres": "Genre",
    "count": "Pistes",
    "tempo": "Tempo (bpm)",
    "centroid": "Centroid (Hz)",
    "rms": "RMS",
    "zcr": "ZCR",
    "flatness": "Flatness",
    "z_centroid": "Z Centroid",
    "z_rms": "Z RMS",
}

# --- Fixed values: learning ---------------------------------------------------------------
TRAIN_PERCENT = 80
MIN_SUPPORT = 20
NON_FEATURES = [
    "path", "filename", "TRACK_ID", "meta_path", "genres", "genre", "label_str",
    "track_num", "batch_id", "duration", "user_id",
]
FOREST = {"numTrees": 75, "maxDepth": 10, "maxBins": 32, "minInstancesPerNode": 5, "seed": 42}
BINARY_FOREST = {"numTrees": 100, "maxDepth": 10, "seed": 42}
LOGISTIC = {"maxIter": 100, "regParam": 0.1}
