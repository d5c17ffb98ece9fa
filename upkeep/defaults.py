"""Fixed values. They are part of the result contract; every one is also a parameter."""

# Columns of the matrix.
KEYS = ("date", "aircraftid")
FEATURES = ("sensor_mean_value", "flighthours", "delayedminutes", "flightcycles")
LABEL = "label"

# Columns read from the two warehouse tables.
UTILIZATION_COLUMNS = ("timeid", "aircraftid", "flighthours", "delayedminutes", "flightcycles")
INTERRUPTION_COLUMNS = ("subsystem", "aircraftregistration", "starttime", "kind")

# What counts as an unscheduled interruption, and how far ahead it is predicted.
SUBSYSTEM = 3453
KINDS = ("AircraftOnGround", "Safety", "Delay")
HORIZON_DAYS = 7

# Decimals kept in the matrix.
SCALE = 2

# Train and validation share, folds, and the seed of the row split.
SPLIT = (0.7, 0.3)
FOLDS = 3
SEED = 53838946

# Parameter grids by model, in catalogue order: 51 points.
GRIDS = {
    "Decision Tree": {"maxDepth": [5, 10, 20], "maxBins": [20, 40, 60, 120]},
    "Random Forest": {"numTrees": [10, 20, 30], "maxDepth": [5, 10, 15]},
    "Logistic Regression": {"maxIter": [10, 50, 100], "regParam": [0.01, 0.1, 0.5]},
    "Gradient-Boosted Trees": {"maxIter": [10, 20, 30], "maxDepth": [3, 5, 7]},
    "Linear SVC": {"maxIter": [10, 50, 100], "regParam": [0.01, 0.1, 0.5]},
    "Naive Bayes": {"smoothing": [0.0, 1.0, 2.0]},
}

# One point of each grid, for short searches.
SMALL_GRIDS = {
    "Decision Tree": {"maxDepth": [5], "maxBins": [20]},
    "Random Forest": {"numTrees": [10], "maxDepth": [5]},
    "Logistic Regression": {"maxIter": [10], "regParam": [0.01]},
    "Gradient-Boosted Trees": {"maxIter": [10], "maxDepth": [3]},
    "Linear SVC": {"maxIter": [10], "regParam": [0.01]},
    "Naive Bayes": {"smoothing": [1.0]},
}

# Verdict texts.
VERDICT_CLEAR = "No maintenance predicted for the next {days} days"
VERDICT_DUE = "Unscheduled maintenance predicted in the next {days} days"

# Name under which a training is recorded.
RUN_NAME = "Model Training Run"
