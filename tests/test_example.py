import csv
import random

from examples.classify_posts import main
from textmine import sources


def test_whole_chain(spark, tmp_path):
    rng = random.Random(2)
    words = {"plants": "soil leaf root seed", "planes": "wing pilot fuel runway", "phones": "app screen"}
    with open(tmp_path / "posts.csv", "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(["Title", "Body", "Category"])
        for i in range(150):
            cat = rng.choices(list(words), [5, 3, 2])[0]
            body = " ".join(rng.choices(words[cat].split(), k=6))
            writer.writerow([f'About "{cat[:3]}" {i}', f"<p>{body}\n</p>", cat])
    scores = main(spark, str(tmp_path / "posts.csv"), str(tmp_path / "out"), "plants")
    assert set(scores) == {"f1", "f1 without plants", "svc f1 plants"}
    assert all(score > 0.95 for score in scores.values())
    model = sources.load_model(str(tmp_path / "out/models/features"))
    corpus = sources.read_csv(spark, str(tmp_path / "out/corpus"), multi_line=False)
    assert model.transform(corpus).count() == 150
