import pytest

from transitlake import cli
from transitlake.plans import config as C
from transitlake.plans.scheduler import Scheduler

TOML = """
[storage]
type = "filesystem"
[storage.params]
base_directory = "data"
[[providers]]
name = "a"
timezone = "Europe/Amsterdam"
frequency_minutes = 15
  [providers.storage]
  type = "minio"
  [providers.storage.params]
  bucket_name = "b"
  [[providers.apis]]
  url = "http://x/1"
  services = ["VehiclePosition", "Alert"]
  [[providers.apis]]
  url = "http://x/2"
  services = ["Shape"]
  refresh_seconds = 20
  frequency_minutes = 5
  check_interval_seconds = 10
  accumulate_count = 3
[[providers]]
name = "b"
  [[providers.apis]]
  url = "http://y"
  services = ["TripUpdate"]
"""


@pytest.fixture
def path(tmp_path):
    p = tmp_path / "c.toml"
    p.write_text(TOML)
    return p


def test_load(path):
    c = C.load_config_from_toml(path)
    a, b = c.providers
    assert c.storage == C.StorageConfig("filesystem", {"base_directory": "data"}) and c.output == C.OutputConfig()
    assert a.apis[0] == C.ApiConfig("http://x/1", ("VehiclePosition", "Alert"), 60, 60, 300, 0) and a.apis[1].accumulate_count == 3
    assert b.timezone == "UTC" and c.provider_storage("b") is c.storage and c.provider_storage("a").type == "minio"
    with pytest.raises(ValueError, match="no provider"):
        c.provider_storage("z")


def test_effective_values():
    p = C.ProviderConfig("p", (), frequency_minutes=15, check_interval_seconds=10)
    assert C.effective_api(p, C.ApiConfig("u", ("Alert",))) == C.ApiConfig("u", ("Alert",), frequency_minutes=15, check_interval_seconds=10)
    own = C.ApiConfig("u", ("Alert",), frequency_minutes=5, check_interval_seconds=20)
    assert C.effective_api(p, own) == own and C.effective_api(C.ProviderConfig("p", ()), own) == own


@pytest.mark.parametrize(("old", "new", "message"), [
    ('type = "filesystem"', "", "storage.type"), ('name = "a"', "", "provider.name"), ('type = "minio"', "", "storage.type"), ('url = "http://y"', "", "apis.url"),
    ('services = ["Shape"]', "", "apis.services"), ('services = ["Shape"]', "services = []", "apis.services"), ('services = ["Shape"]', 'services = ["Boat"]', "no service"),
    ("refresh_seconds = 20", "refresh_seconds = 0", "positive"), ("frequency_minutes = 5", "frequency_minutes = -1", "positive"), ("Europe/Amsterdam", "Mars/Base", "no time zone"),
    ('name = "b"', 'name = "a"', "must differ"), ('"filesystem"', '"tape"', "no storage type"), ("accumulate_count = 3", "accumulate_count = -3", "negative"),
])
def test_what_is_wrong_is_refused(path, old, new, message):
    path.write_text(TOML.replace(old, new))
    with pytest.raises(ValueError, match=message):
        C.load_config_from_toml(path)
    with pytest.raises(ValueError, match="Error loading configuration"):
        C.load_config_from_toml_file(path)


def test_empty_lists():
    with pytest.raises(ValueError, match="No providers"):
        C.config_from_dict({"storage": {"type": "filesystem"}})
    with pytest.raises(ValueError, match="No APIs"):
        C.config_from_dict({"storage": {"type": "filesystem"}, "providers": [{"name": "p"}]})


def test_missing_file(tmp_path):
    with pytest.raises(FileNotFoundError):
        C.load_config_from_toml(tmp_path / "none.toml")
    with pytest.raises(ValueError, match="Error loading"):
        C.load_config_from_toml_file(tmp_path / "none.toml")


def test_cli(path, monkeypatch, capsys):
    seen = []
    monkeypatch.setattr(cli, "run_pipeline_from_toml", seen.append)
    assert cli.main([str(path), "--log-level", "debug"]) == 0 and seen == [str(path)]
    with pytest.raises(SystemExit):
        cli.main([])
    monkeypatch.undo()
    assert cli.main([str(path.parent / "none.toml")]) == 1 and capsys.readouterr().out.startswith("Error:")


def test_scheduler_runs_what_is_due_once_at_a_time():
    now, ran, gate = [0.0], [], __import__("threading").Event()

    def slow(tag):
        ran.append(tag)
        gate.wait(10)

    s = Scheduler(clock=lambda: now[0])
    s.add_schedules([(10, slow, "slow", {"tag": "s"}), (3, ran.append, "quick", {}), (5, lambda: 1 / 0, "broken", {})])
    s.jobs[1].kwargs, s.jobs[1].run = {}, lambda: ran.append("q")
    counts = []
    for t in range(1, 22):
        now[0] = t
        counts.append(s.tick())
        for j in s.jobs[1:]:
            if j.future:
                j.future.result(5)
    gate.set()
    assert ran.count("q") == 7 and ran.count("s") == 1 and sum(counts) == 7 + 1 + 4
    s.stop()
    assert s.jobs == []


def test_lifecycle_ends_the_run():
    left = [3]

    def more():
        left[0] -= 1
        return left[0] > 0

    s = Scheduler([("countdown", more)], pause=0.01)
    s.start()
    assert not s.running and left[0] == 0
