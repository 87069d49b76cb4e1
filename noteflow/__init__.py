"""noteflow: note-score and labelled-corpus analytics on Spark DataFrames."""
