"""Jobs that chain operators into the stages of a training-data build."""
