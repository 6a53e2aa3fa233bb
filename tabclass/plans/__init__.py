"""Compositions: dataset recipes, classifier registry, training, experiments, results."""
