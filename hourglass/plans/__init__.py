from .workflow import Evaluation, Prepared, evaluate_at_k, explore, name_recommendations, prepare, train_evaluate

__all__ = ["Evaluation", "Prepared", "evaluate_at_k", "explore", "name_recommendations", "prepare", "train_evaluate"]
